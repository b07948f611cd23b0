"""Games folded where they are read: no text is joined or shuffled, games of a batch don't touch, half-moves by look-up."""

import pyarrow as pa
from pyspark.sql import functions as F

from pawnshop.operators import movefold as MF
from pawnshop.operators.enrich import enriched_games
from pawnshop.plans import adapters as ad
from tests.conftest import SF001

GAMES = [(1, "1. e4 a6 2. e5 d5 3. exd6 Nc6 4. dxc7 Bd7 5. cxd8=Q+ Rxd8 *", "White"), (2, " ", "Black"), (3, None, "Draw"), (4, "*", None),
         (5, "1. e4 e5 2. Ke2 O-O 3. Kxe3", "Black")]


def test_enriched_games_join_no_text(spark):
    games = spark.createDataFrame(GAMES, "game_id long, movetext string, Winner string")
    out = enriched_games(games, "game_id", "movetext", "Winner", {"mid": 8, "final": None})
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "movetext" not in plan and "aggregate(" not in plan and "Python" not in plan
    got = {(r.game_id, r.phase): (r.total_moves, r.label_white_win, r.material_white, r.material_black) for r in out.collect()}
    assert got == {(1, "mid"): (5, 1, 39.0, 37.0), (1, "final"): (5, 1, 38.0, 28.0), (4, "mid"): (0, None, 39.0, 39.0), (4, "final"): (0, None, 39.0, 39.0),
                   (5, "mid"): (3, 0, 39.0, 39.0), (5, "final"): (3, 0, 39.0, 39.0)}


def test_repeated_keys_keep_their_rows(spark):
    games = spark.createDataFrame([(1, "e4", "White"), (1, "e4 e5 d4", "Black")], "game_id long, movetext string, Winner string")
    out = enriched_games(games, "game_id", "movetext", "Winner", {"final": None})
    assert out.count() == 2 ** 3  # features, outcomes and lengths of the key, each with each


def test_slices_of_a_batch_give_the_same_games(monkeypatch):
    lines = [["e4", "e5", "Nf3"], None, [], ["d4"] * 50, ["O-O-O", "O-O"], ["a4", "b5", "axb6"]]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(lines, pa.list_(pa.string()))], ["k", "line"])
    games = lambda: [(keys.to_pylist(), [c.tolist() for c in f.snapshot(2)]) for (keys,), _, f in MF._some_games(batch)]
    whole = games()
    monkeypatch.setattr(MF, "EVENTS", 1)
    parts = games()
    assert len(whole) == 1 and len(parts) == 6
    assert whole[0][1] == [sum((p[1][c] for p in parts), []) for c in range(6)]


def test_half_moves_by_look_up_equal_the_expression(spark):
    words = [a + m + z for a in "abhzAZ0(é" for m in ("", "x", "word,", "{y}", "exactlyten") for z in ("", ".", ",", "b", "q", "Z", "ß")]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, w string")
    x = F.struct("w", F.ascii("w").alias("a"), F.ascii(F.right("w", F.lit(1))).alias("z"), F.length("w").alias("n"))
    rows = df.select("w", ad._half_move(x, F.col("i")).alias("got"), F.expr(ad._token_expr("w", "i")).alias("expected")).collect()
    assert [r for r in rows if r.got != r.expected] == []


def test_conditions_on_features_stay_above_the_written_features(spark):
    from pawnshop.operators.learn import prepared

    features = ["material_diff", "white_pawns"]
    games = spark.createDataFrame(GAMES, "game_id long, movetext string, Winner string")
    rows = prepared(enriched_games(games, "game_id", "movetext", "Winner", {"final": None}), "label_white_win", features, "game_id")
    assert sorted(r.game_id for r in rows.collect()) == [1, 5]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" in plan and "LogicalRDD" in plan and "bit_count" not in plan


def test_csv_inputs_are_written_by_as_many_tasks_as_the_sort_has(spark):
    from pawnshop.plans import catalog_sources as C

    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for path in (C._games_csv(spark, SF001, header=True), C._docs_csv(spark, SF001)):
            assert len(spark.read.text(path).inputFiles()) > 3
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
