"""Registered queries, groups 1-4 and 6-7: profiles, sampling, evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from pawnshop.functions.scalar import binary_label, hash_unit, outcome_flag, safe_cast, text_quality
from pawnshop.operators import evaluate as ev, profile as pr, sampling as sa
from pawnshop.plans import adapters as ad
from pawnshop.plans.common import R, rounded
from pawnshop.schema import QUARTILE_LABELS
from pawnshop.session import checkpoint_dir, scratch_path
from pawnshop.sources import read_parquet, write_parquet

G = ad.with_ctes(ad.GAMES_SQL)
S = ad.with_ctes(ad.SCORES_SQL)
GS = ad.with_ctes(ad.GAMES_SQL, ad.SCORES_SQL)

Q: dict = {}
SQL: dict = {}


def register(name, sql=None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def _games(spark, d):
    return ad.games(spark, d)


def _profile(spark, d):
    return pr.entity_profile(_games(spark, d), "WhiteName", "WhiteElo", "Opening", "Winner")


# ----------------------------------------------------------------- group 1

@register("category_count", G + "\nSELECT Opening, count(*) AS n FROM games GROUP BY Opening")
def q_category_count(spark, d):
    return pr.category_count(_games(spark, d), "Opening")


@register("top_k_categories", G + """
SELECT Opening, count(*) AS n FROM games GROUP BY Opening
ORDER BY n DESC, Opening ASC NULLS FIRST LIMIT 20""")
def q_top_k(spark, d):
    return pr.top_k_categories(_games(spark, d), "Opening", 20)


@register("heavy_hitters", G + """
SELECT WhiteName, count(*) AS n FROM games GROUP BY WhiteName
ORDER BY n DESC, WhiteName ASC NULLS FIRST LIMIT 20""")
def q_heavy_hitters(spark, d):
    """A2/A3: the players with most games, though only candidates and open buckets are counted by name."""
    checkpoint_dir(spark)
    return pr.heavy_hitters(_games(spark, d), "WhiteName", 20)


@register("distinct_values", G + "\nSELECT DISTINCT trim(TimeControl) AS TimeControl FROM games")
def q_distinct(spark, d):
    return pr.distinct_values(_games(spark, d), "TimeControl")


@register("filtered_count", G + "\nSELECT count(*) AS n FROM games WHERE Winner = 'White'")
def q_filtered_count(spark, d):
    return pr.filtered_count(_games(spark, d), "Winner", "White")


@register("global_means", G + f"""
SELECT {R('avg(WhiteElo)')} AS avg_WhiteElo, {R('avg(BlackElo)')} AS avg_BlackElo,
       {R('avg(TRY_CAST(Number_of_Moves AS INTEGER))')} AS avg_Number_of_Moves FROM games""")
def q_global_means(spark, d):
    return rounded(pr.global_means(_games(spark, d), ["WhiteElo", "BlackElo", "Number_of_Moves"],
                                   {"Number_of_Moves": "int"}))


# ----------------------------------------------------------------- group 2

_VALID = """valid AS (SELECT WhiteName AS Player, WhiteElo AS Elo, Opening FROM games
  WHERE WhiteName IS NOT NULL AND WhiteElo IS NOT NULL AND Opening IS NOT NULL)"""
_PAIRS = "pairs AS (SELECT Player, Opening, count(*) AS freq_abs FROM valid GROUP BY Player, Opening)"
_REL = """rel AS (SELECT p.Player, p.Opening, p.freq_abs, t.total, p.freq_abs / t.total AS freq_rel
  FROM pairs p JOIN (SELECT Player, sum(freq_abs) AS total FROM pairs GROUP BY Player) t USING (Player))"""
_ENT = "ent AS (SELECT Player, sum(-freq_rel * log2(freq_rel)) AS H FROM rel WHERE freq_rel > 0 GROUP BY Player)"
G2 = ad.with_ctes(ad.GAMES_SQL, _VALID, _PAIRS, _REL, _ENT)


@register("entity_mean_count", G2 + f"""
SELECT Player, {R('avg(Elo)')} AS AvgElo, count(*) AS Games FROM valid GROUP BY Player""")
def q_entity_mean_count(spark, d):
    return rounded(pr.entity_mean_count(_games(spark, d), "WhiteName", "WhiteElo", "Opening"))


@register("pair_frequency", G2 + "\nSELECT Player, Opening, freq_abs FROM pairs")
def q_pair_frequency(spark, d):
    return pr.pair_frequency(_games(spark, d), "WhiteName", "WhiteElo", "Opening")


@register("relative_frequency", G2 + f"""
SELECT Player, Opening, freq_abs, CAST(total AS BIGINT) AS total, {R('freq_rel')} AS freq_rel FROM rel""")
def q_relative_frequency(spark, d):
    return rounded(pr.relative_frequency(_games(spark, d), "WhiteName", "WhiteElo", "Opening"))


@register("shannon_entropy", G2 + f"\nSELECT Player, {R('H')} AS ShannonEntropy FROM ent")
def q_shannon_entropy(spark, d):
    return rounded(pr.shannon_entropy(_games(spark, d), "WhiteName", "WhiteElo", "Opening"))


PROFILE_SQL = G2 + f""",
elo AS (SELECT Player, avg(Elo) AS AvgWhiteElo, count(*) AS GamesAsWhite FROM valid GROUP BY Player),
wins AS (SELECT WhiteName AS Player, count(*) AS w FROM games
         WHERE WhiteName IS NOT NULL AND Winner = 'White' GROUP BY WhiteName),
profile AS (
  SELECT e.Player, elo.AvgWhiteElo, elo.GamesAsWhite, e.H AS ShannonEntropy,
         CAST(coalesce(wins.w, 0) AS BIGINT) AS WinsAsWhite
  FROM ent e JOIN elo USING (Player) LEFT JOIN wins USING (Player))"""


@register("entity_profile", PROFILE_SQL + f"""
SELECT Player, {R('AvgWhiteElo')} AS AvgWhiteElo, GamesAsWhite, {R('ShannonEntropy')} AS ShannonEntropy,
       WinsAsWhite FROM profile""")
def q_entity_profile(spark, d):
    return rounded(_profile(spark, d))


@register("entity_profile_merged", PROFILE_SQL + f"""
SELECT Player, {R('AvgWhiteElo')} AS AvgWhiteElo, GamesAsWhite, {R('ShannonEntropy')} AS ShannonEntropy,
       WinsAsWhite FROM profile""")
def q_entity_profile_merged(spark, d):
    """J3/J4/A10/A11 kept up to date: a written state takes in a second batch; the profile of all games is read from it."""
    columns = ("WhiteName", "WhiteElo", "Opening", "Winner")
    games = _games(spark, d)
    first = hash_unit("game_id", 42, "batch") < 0.5
    kept, path = scratch_path(spark, "profile"), scratch_path(spark, "profile")
    write_parquet(pr.profile_state(games.where(first), *columns), kept)
    write_parquet(pr.merge_states(read_parquet(spark, kept), pr.profile_state(games.where(~first), *columns)), path)
    return rounded(pr.profile_from_state(read_parquet(spark, path)))


# ----------------------------------------------------------------- group 3

@register("binary_label", G + """
SELECT game_id, Winner, CASE WHEN lower(regexp_replace(Winner, '^\\s+|\\s+$', '', 'g')) = 'white' THEN 1
  WHEN lower(regexp_replace(Winner, '^\\s+|\\s+$', '', 'g')) IN ('black', 'draw') THEN 0 END AS label_white_win FROM games""")
def q_binary_label(spark, d):
    g = _games(spark, d)
    return g.select("game_id", "Winner", binary_label("Winner").alias("label_white_win"))


@register("outcome_flags", G + """
SELECT game_id, CASE WHEN Winner = 'White' THEN 1 ELSE 0 END AS white_win,
  CASE WHEN Winner = 'Black' THEN 1 ELSE 0 END AS black_win,
  CASE WHEN Winner = 'Draw' THEN 1 ELSE 0 END AS draw FROM games""")
def q_outcome_flags(spark, d):
    g = _games(spark, d)
    return g.select("game_id", outcome_flag("Winner", "White").alias("white_win"),
                    outcome_flag("Winner", "Black").alias("black_win"),
                    outcome_flag("Winner", "Draw").alias("draw"))


@register("group_outcome_profile", G + f"""
SELECT trim(TimeControl) AS TimeControl, count(*) AS games,
  {R('avg(TRY_CAST(Number_of_Moves AS INTEGER))')} AS avg_moves,
  {R("avg(CASE WHEN Winner = 'White' THEN 1 ELSE 0 END)")} AS prop_white_win,
  {R("avg(CASE WHEN Winner = 'Black' THEN 1 ELSE 0 END)")} AS prop_black_win,
  {R("avg(CASE WHEN Winner = 'Draw' THEN 1 ELSE 0 END)")} AS prop_draw
FROM games GROUP BY trim(TimeControl)""")
def q_group_outcome_profile(spark, d):
    return rounded(pr.group_outcome_profile(_games(spark, d), "TimeControl", "Winner", "Number_of_Moves"))


@register("safe_cast", G + "\nSELECT game_id, TRY_CAST(Number_of_Moves AS INTEGER) AS moves FROM games")
def q_safe_cast(spark, d):
    return _games(spark, d).select("game_id", safe_cast("Number_of_Moves", "int").alias("moves"))


_LABELLED = """labelled AS (
  SELECT game_id, CASE WHEN lower(regexp_replace(Winner, '^\\s+|\\s+$', '', 'g')) = 'white' THEN 1
    WHEN lower(regexp_replace(Winner, '^\\s+|\\s+$', '', 'g')) IN ('black', 'draw') THEN 0 END AS label_white_win,
    WhiteElo, BlackElo, TRY_CAST(Number_of_Moves AS INTEGER) AS moves FROM games)"""
G3 = ad.with_ctes(ad.GAMES_SQL, _LABELLED)


def _labelled(spark, d):
    g = _games(spark, d)
    return g.select("game_id", binary_label("Winner").alias("label_white_win"), "WhiteElo", "BlackElo",
                    safe_cast("Number_of_Moves", "int").alias("moves"))


@register("complete_cases", G3 + """
SELECT * FROM labelled WHERE label_white_win IN (0, 1) AND WhiteElo IS NOT NULL
  AND BlackElo IS NOT NULL AND moves IS NOT NULL""")
def q_complete_cases(spark, d):
    from pawnshop.operators.reshape import complete_cases
    return complete_cases(_labelled(spark, d), "label_white_win", ["WhiteElo", "BlackElo", "moves"], ["game_id"])


@register("conditional_means", G3 + f"""
SELECT label_white_win, {R('avg(WhiteElo)')} AS avg_WhiteElo, {R('avg(BlackElo)')} AS avg_BlackElo,
  {R('avg(moves)')} AS avg_moves FROM labelled GROUP BY label_white_win""")
def q_conditional_means(spark, d):
    return rounded(pr.conditional_means(_labelled(spark, d), "label_white_win",
                                        ["WhiteElo", "BlackElo", "moves"]))


# ----------------------------------------------------------------- group 4

_QB = f""",
edges AS (SELECT quantile_cont(AvgWhiteElo, 0.0) AS e0, quantile_cont(AvgWhiteElo, 0.25) AS e1,
  quantile_cont(AvgWhiteElo, 0.5) AS e2, quantile_cont(AvgWhiteElo, 0.75) AS e3,
  quantile_cont(AvgWhiteElo, 1.0) AS e4 FROM profile),
binned AS (SELECT p.*, CASE WHEN AvgWhiteElo IS NULL THEN NULL
  WHEN AvgWhiteElo >= e0 AND AvgWhiteElo <= e1 THEN '{QUARTILE_LABELS[0]}'
  WHEN AvgWhiteElo > e1 AND AvgWhiteElo <= e2 THEN '{QUARTILE_LABELS[1]}'
  WHEN AvgWhiteElo > e2 AND AvgWhiteElo <= e3 THEN '{QUARTILE_LABELS[2]}'
  WHEN AvgWhiteElo > e3 AND AvgWhiteElo <= e4 THEN '{QUARTILE_LABELS[3]}' END AS elo_bin
  FROM profile p, edges)"""


@register("quantile_bins", PROFILE_SQL + _QB + f"""
SELECT Player, {R('AvgWhiteElo')} AS AvgWhiteElo, elo_bin FROM binned""")
def q_quantile_bins(spark, d):
    b = pr.quantile_bins(_profile(spark, d), "AvgWhiteElo", QUARTILE_LABELS, "elo_bin")
    return rounded(b.select("Player", "AvgWhiteElo", "elo_bin"))


@register("bin_summary", PROFILE_SQL + _QB + f""",
box AS (SELECT elo_bin, quantile_cont(ShannonEntropy, 0.25) AS q1, quantile_cont(ShannonEntropy, 0.5) AS median,
  quantile_cont(ShannonEntropy, 0.75) AS q3 FROM binned GROUP BY elo_bin)
SELECT b.elo_bin, {R('b.q1')} AS q1, {R('b.median')} AS median, {R('b.q3')} AS q3, count(*) AS n,
  {R('min(CASE WHEN x.ShannonEntropy BETWEEN b.q1 - 1.5 * (b.q3 - b.q1) AND b.q3 + 1.5 * (b.q3 - b.q1) THEN x.ShannonEntropy END)')} AS whisker_low,
  {R('max(CASE WHEN x.ShannonEntropy BETWEEN b.q1 - 1.5 * (b.q3 - b.q1) AND b.q3 + 1.5 * (b.q3 - b.q1) THEN x.ShannonEntropy END)')} AS whisker_high,
  count(*) FILTER (WHERE NOT (x.ShannonEntropy BETWEEN b.q1 - 1.5 * (b.q3 - b.q1) AND b.q3 + 1.5 * (b.q3 - b.q1))) AS outliers
FROM binned x JOIN box b ON x.elo_bin = b.elo_bin
GROUP BY b.elo_bin, b.q1, b.median, b.q3""")
def q_bin_summary(spark, d):
    b = pr.quantile_bins(_profile(spark, d), "AvgWhiteElo", QUARTILE_LABELS, "elo_bin")
    return rounded(pr.bin_summary(b.where(F.col("elo_bin").isNotNull()), "elo_bin", "ShannonEntropy"))


@register("histogram", G + f""",
mm AS (SELECT min(WhiteElo) AS lo, max(WhiteElo) AS hi FROM games),
w AS (SELECT lo, CASE WHEN hi > lo THEN (hi - lo) / 40 ELSE 1.0 END AS width FROM mm),
b AS (SELECT CAST(least(floor((WhiteElo - lo) / width), 39) AS INTEGER) AS bin, lo, width
      FROM games, w WHERE WhiteElo IS NOT NULL)
SELECT bin, {R('min(lo) + bin * min(width)')} AS lo, {R('min(lo) + (bin + 1) * min(width)')} AS hi, count(*) AS n
FROM b GROUP BY bin""")
def q_histogram(spark, d):
    return rounded(pr.histogram(_games(spark, d), "WhiteElo", 40))


_HASH = "(('0x' || substr(md5('{purpose}:{seed}:' || CAST({key} AS VARCHAR)), 1, 8))::BIGINT / 4294967296.0)"


def hsql(key: str, purpose: str = "sample", seed: int = 42) -> str:
    return _HASH.format(key=key, seed=seed, purpose=purpose)


@register("sampled_category_count", G + f"""
SELECT Winner, count(*) AS n FROM games WHERE {hsql('game_id')} < 0.1 GROUP BY Winner""")
def q_sampled_category_count(spark, d):
    return pr.sampled_category_count(_games(spark, d), "game_id", "Winner", 0.1)


@register("scatter_sample", G + f"""
SELECT game_id, {R('WhiteElo')} AS WhiteElo, Number_of_Moves FROM games WHERE {hsql('game_id')} < 0.1""")
def q_scatter_sample(spark, d):
    return rounded(pr.scatter_sample(_games(spark, d), "game_id", ["WhiteElo", "Number_of_Moves"], 0.1))


# ----------------------------------------------------------------- group 5

@register("text_quality_filter", ad.with_ctes(ad.MOVETEXT_SQL) + r"""
SELECT game_id FROM movetext WHERE movetext IS NOT NULL AND length(movetext) > 0
  AND regexp_matches(movetext, '^\s*1\.')""")
def q_text_quality(spark, d):
    return ad.movetext(spark, d).where(text_quality("movetext")).select("game_id")


# ----------------------------------------------------------------- group 6

@register("hash_sample", G + f"\nSELECT game_id FROM games WHERE {hsql('game_id')} < 0.1")
def q_hash_sample(spark, d):
    return sa.hash_sample(_games(spark, d), "game_id", 0.1).select("game_id")


@register("hash_split", G + f"""
SELECT game_id, CASE WHEN {hsql('game_id', 'split')} < 0.8 THEN 'train' ELSE 'test' END AS split FROM games""")
def q_hash_split(spark, d):
    return sa.hash_split(_games(spark, d), "game_id").select("game_id", "split")


@register("hash_shuffle", G + f"""
SELECT game_id, row_number() OVER (ORDER BY {hsql('game_id', 'shuffle')}, game_id) - 1 AS position FROM games""")
def q_hash_shuffle(spark, d):
    return sa.hash_shuffle(_games(spark, d).select("game_id"), "game_id")


@register("head_by_key", G + "\nSELECT game_id, Winner FROM games ORDER BY game_id LIMIT 100")
def q_head_by_key(spark, d):
    return sa.head_by_key(_games(spark, d).select("game_id", "Winner"), "game_id", 100)


_LAB = """lab AS (SELECT game_id, CASE WHEN lower(regexp_replace(Winner, '^\\s+|\\s+$', '', 'g')) = 'white' THEN 1
  WHEN lower(regexp_replace(Winner, '^\\s+|\\s+$', '', 'g')) IN ('black', 'draw') THEN 0 END AS label FROM games)"""
G6 = ad.with_ctes(ad.GAMES_SQL, _LAB)


def _lab(spark, d):
    return _games(spark, d).select("game_id", binary_label("Winner").alias("label"))


@register("balance_classes", G6 + f""",
cnt AS (SELECT label, count(*) AS c FROM lab WHERE label IS NOT NULL GROUP BY label),
frac AS (SELECT label, CASE WHEN (SELECT count(*) FROM cnt) < 2 THEN 1.0
  WHEN c = (SELECT min(c) FROM cnt) THEN 1.0
  ELSE least(1.0, 1.0 * (SELECT min(c) FROM cnt) / c) END AS f FROM cnt)
SELECT lab.game_id, lab.label FROM lab JOIN frac USING (label) WHERE {hsql('lab.game_id', 'balance')} < f""")
def q_balance(spark, d):
    return sa.balance_classes(_lab(spark, d), "label", "game_id").select("game_id", "label")


@register("balance_then_split", G6 + f""",
cnt AS (SELECT label, count(*) AS c FROM lab WHERE label IS NOT NULL GROUP BY label),
frac AS (SELECT label, CASE WHEN (SELECT count(*) FROM cnt) < 2 THEN 1.0
  WHEN c = (SELECT min(c) FROM cnt) THEN 1.0
  ELSE least(1.0, 1.0 * (SELECT min(c) FROM cnt) / c) END AS f FROM cnt)
SELECT lab.game_id, lab.label, CASE WHEN {hsql('lab.game_id', 'split')} < 0.8 THEN 'train' ELSE 'test' END AS split
FROM lab JOIN frac USING (label) WHERE {hsql('lab.game_id', 'balance')} < f""")
def q_balance_then_split(spark, d):
    balanced = sa.balance_classes(_lab(spark, d), "label", "game_id")
    return sa.hash_split(balanced, "game_id").select("game_id", "label", "split")


@register("sample_then_split", G6 + f"""
SELECT game_id, label, CASE WHEN {hsql('game_id', 'split')} < 0.8 THEN 'train' ELSE 'test' END AS split
FROM lab WHERE {hsql('game_id')} < 0.1""")
def q_sample_then_split(spark, d):
    return sa.hash_split(sa.hash_sample(_lab(spark, d), "game_id", 0.1), "game_id").select("game_id", "label", "split")


@register("class_weights", G6 + f""",
cnt AS (SELECT label, count(*) AS c FROM lab WHERE label IS NOT NULL GROUP BY label),
pn AS (SELECT coalesce(sum(c) FILTER (WHERE label = 1), 0) AS pos,
              coalesce(sum(c) FILTER (WHERE label <> 1), 0) AS neg FROM cnt)
SELECT game_id, label, {R("CASE WHEN label = 1 AND pos > 0 THEN neg / pos ELSE 1.0 END")} AS class_weight
FROM lab, pn""")
def q_class_weights(spark, d):
    return rounded(sa.class_weights(_lab(spark, d), "label").select("game_id", "label", "class_weight"))


@register("stratified_split", G6 + f""",
r AS (SELECT game_id, label, row_number() OVER (PARTITION BY label ORDER BY {hsql('game_id', 'split')}, game_id) - 1 AS pos,
      count(*) OVER (PARTITION BY label) AS n FROM lab WHERE label IS NOT NULL)
SELECT game_id, label, CASE WHEN pos < ceil(n * 0.2) THEN 'test'
  WHEN pos < ceil(n * 0.2) + ceil((n - ceil(n * 0.2)) * 0.25) THEN 'validation' ELSE 'train' END AS split
FROM r""")
def q_stratified_split(spark, d):
    return sa.stratified_split(_lab(spark, d), "label", "game_id").select("game_id", "label", "split")


# ----------------------------------------------------------------- group 7

def _scores(spark, d):
    return ad.scores(spark, d)


def _metric_sql(src: str, keep: str = "") -> str:
    acc = "CASE WHEN tp + tn + fp + fn > 0 THEN (tp + tn) / (tp + tn + fp + fn) ELSE 0.0 END"
    prec = "CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END"
    rec = "CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END"
    f1 = f"CASE WHEN ({prec}) + ({rec}) > 0 THEN 2 * ({prec}) * ({rec}) / (({prec}) + ({rec})) ELSE 0.0 END"
    return (f"SELECT {keep}tp, tn, fp, fn, {R(acc)} AS accuracy, {R(prec)} AS precision, "
            f"{R(rec)} AS recall, {R(f1)} AS f1 FROM {src}")


def _counts_sql(t: str) -> str:
    return (f"count(*) FILTER (WHERE label = 1 AND prob1 >= {t}) AS tp, "
            f"count(*) FILTER (WHERE label = 0 AND NOT prob1 >= {t}) AS tn, "
            f"count(*) FILTER (WHERE label = 0 AND prob1 >= {t}) AS fp, "
            f"count(*) FILTER (WHERE label = 1 AND NOT prob1 >= {t}) AS fn")


@register("confusion_metrics", S + ",\nc AS (SELECT " + _counts_sql("0.5") + " FROM scores WHERE label IN (0, 1))\n"
          + _metric_sql("c"))
def q_confusion(spark, d):
    return rounded(ev.confusion_metrics(_scores(spark, d), "label", score="prob1", threshold=0.5))


_SCAN = S + ",\nc AS (" + "\nUNION ALL ".join(
    f"SELECT {t} AS threshold, " + _counts_sql(str(t)) + " FROM scores WHERE label IN (0, 1)"
    for t in (0.3, 0.4, 0.5, 0.6, 0.7)) + ")"


@register("threshold_scan", _SCAN + "\n" + _metric_sql("c", f"{R('threshold')} AS threshold, "))
def q_threshold_scan(spark, d):
    return rounded(ev.threshold_scan(_scores(spark, d), "label", "prob1"))


@register("best_threshold", _SCAN + ",\nm AS (" + _metric_sql("c", f"{R('threshold')} AS threshold, ")
          + ")\nSELECT * FROM m ORDER BY f1 DESC, threshold ASC LIMIT 1")
def q_best_threshold(spark, d):
    return ev.best_threshold(rounded(ev.threshold_scan(_scores(spark, d), "label", "prob1")))


@register("roc_auc", S + f""",
ranked AS (SELECT label, rank() OVER (ORDER BY prob1) + (count(*) OVER (PARTITION BY prob1) - 1) / 2.0 AS r
           FROM scores WHERE label IN (0, 1) AND prob1 IS NOT NULL),
agg AS (SELECT sum(r) FILTER (WHERE label = 1) AS rs, count(*) FILTER (WHERE label = 1) AS p,
               count(*) FILTER (WHERE label = 0) AS n FROM ranked)
SELECT {R('CASE WHEN p > 0 AND n > 0 THEN (rs - p * (p + 1) / 2.0) / (p * n) END')} AS auc FROM agg""")
def q_roc_auc(spark, d):
    return rounded(ev.roc_auc(_scores(spark, d), "label", "prob1"))


@register("regression_metrics", S + f"""
SELECT {R('sqrt(avg((label - prob1) * (label - prob1)))')} AS rmse,
  {R('1 - sum((label - prob1) * (label - prob1)) / sum((label - (SELECT avg(label) FROM scores)) * (label - (SELECT avg(label) FROM scores)))')} AS r2
FROM scores""")
def q_regression_metrics(spark, d):
    return rounded(ev.regression_metrics(_scores(spark, d), "label", "prob1"))


@register("top_k_abs", S + f"""
SELECT game_id, {R('prob1 - 0.5')} AS margin FROM scores ORDER BY abs(prob1 - 0.5) DESC, game_id LIMIT 15""")
def q_top_k_abs(spark, d):
    s = _scores(spark, d).select("game_id", (F.col("prob1") - 0.5).alias("margin"))
    return rounded(ev.top_k_abs(s, "margin", "game_id", 15))
