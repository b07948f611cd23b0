"""The steps between pieces and FEN text work a board's text out once, not once a square."""

from pawnshop.operators import board as B

FENS = ["rnbqkbnr/pppppppp/8/8/4P3/8/PPPP1PPP/RNBQKBNR b KQkq - 0 1", "8/8/8/8/8/8/8/8 w - - 0 1", " 44/53/17/8/p7/8/8/7K", None, "",
        "8/8/8/8/8/8/8", "8/8/8/8/8/8/8/9", "7x/8/8/8/8/8/8/8"]


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_decode_reads_the_text_once(spark):
    df = spark.createDataFrame(list(enumerate(FENS)), "id int, fen string")
    plan = _plan(B.board_decode(df, "fen", ["id"]))
    assert plan.count("trim(") == 1 and plan.count("replace(") <= 10
    rows = {}
    for r in B.board_decode(df, "fen", ["id"]).collect():
        rows.setdefault(r["id"], []).append((r["valid"], r["file"], r["rank"], r["piece"]))
    assert len(rows[0]) == 32 and {(True, 4, 3, "P"), (True, 0, 7, "r"), (True, 7, 0, "R")} <= set(rows[0])
    assert rows[1] == [(True, None, None, None)]
    assert sorted(rows[2], key=str) == [(True, 0, 3, "p"), (True, 7, 0, "K")]
    assert all(rows[k] == [(False, None, None, None)] for k in range(3, 8))


def test_encode_writes_the_text_once(spark):
    pieces = spark.createDataFrame([(1, 0, 0, "R"), (1, 7, 7, "k"), (1, 3, 3, "q"), (1, 3, 3, "Q"), (2, 4, 1, "P"), (3, 0, 0, None)],
                                   "id int, file int, rank int, piece string")
    fens = B.fen_encode(pieces, ["id"])
    assert _plan(fens).count("replace(") <= 7 and _plan(fens).count("element_at(") <= 8
    assert {r["id"]: r["fen"] for r in fens.collect()} == {
        1: "7k/8/8/8/3Q4/8/8/R7 w - - 0 1", 2: "8/8/8/8/8/8/4P3/8 w - - 0 1"}
