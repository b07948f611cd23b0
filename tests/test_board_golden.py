"""Golden positions (FIXTURES.md section 4), worked out by hand."""

import pytest

from pawnshop.operators import board as B
from pawnshop.schema import FEATURE_KEYS

FENS = {
    "F1": "rnbqkbnr/pppppppp/8/8/8/8/PPPPPPPP/RNBQKBNR w KQkq - 0 1",
    "F2": "4k3/p2p1p2/8/3P4/1P4p1/1P6/5PPP/6K1 w - - 0 1",
    "F3": "8/8/8/8/8/8/8/K6k w - - 0 1",
    "F4": "8/PPP5/8/4p3/4P3/8/5ppp/8 w - - 0 1",
}
INVALID = [None, "", "   ", "not a fen", "8/8/8/8/8/8/8 w - - 0 1", "9/8/8/8/8/8/8/8 w - - 0 1"]

# (white, black) per position
GOLDEN = {
    "material": {"F1": (39, 39), "F2": (6, 4), "F3": (0, 0), "F4": (4, 4)},
    "pawns": {"F1": (8, 8), "F2": (6, 4), "F3": (0, 0), "F4": (4, 4)},
    "doubled_pawns": {"F1": (0, 0), "F2": (1, 0), "F3": (0, 0), "F4": (0, 0)},
    "isolated_pawns": {"F1": (0, 0), "F2": (3, 2), "F3": (0, 0), "F4": (1, 0)},
    "passed_pawns": {"F1": (0, 0), "F2": (0, 0), "F3": (0, 0), "F4": (3, 3)},
    "advanced_pawns": {"F1": (0, 0), "F2": (1, 1), "F3": (0, 0), "F4": (3, 3)},
    "pawn_islands": {"F1": (1, 1), "F2": (3, 3), "F3": (0, 0), "F4": (2, 1)},
    "king_pawn_shield": {"F1": (3, 3), "F2": (3, 2), "F3": (0, 0), "F4": (0, 0)},
    "king_pawns_near": {"F1": (5, 5), "F2": (3, 2), "F3": (0, 0), "F4": (0, 0)},
}
DISPERSION = {  # (mean, std, span) for file and rank, white then black
    "F1": [(3.5, 2.291288, 7), (3.5, 2.291288, 7), (1, 0, 0), (6, 0, 0)],
    "F2": [(3.833333, 2.339278, 6), (3.5, 2.291288, 6), (2, 1.154701, 3), (5.25, 1.299038, 3)],
    "F3": [(0, 0, 0), (0, 0, 0), (0, 0, 0), (0, 0, 0)],
    "F4": [(1.75, 1.47902, 4), (5.5, 1.118034, 3), (5.25, 1.299038, 3), (1.75, 1.299038, 3)],
}


@pytest.fixture(scope="module")
def features(spark):
    rows = [(i, f) for i, f in enumerate(FENS.values())] + [(100 + i, f) for i, f in enumerate(INVALID)]
    df = spark.createDataFrame(rows, "id long, fen string")
    out = B.position_features(B.board_decode(df, "fen", ["id"]), ["id"]).collect()
    return {r["id"]: r.asDict() for r in out}


@pytest.mark.parametrize("name", list(FENS))
def test_golden_counts(features, name):
    f = features[list(FENS).index(name)]
    assert (f["material_white"], f["material_black"]) == GOLDEN["material"][name]
    for feat, table in GOLDEN.items():
        if feat == "material":
            continue
        assert (f[f"white_{feat}"], f[f"black_{feat}"]) == table[name], feat


@pytest.mark.parametrize("name", list(FENS))
def test_golden_dispersion(features, name):
    f = features[list(FENS).index(name)]
    wf, bf, wr, br = DISPERSION[name]
    for side, axis, exp in (("white", "file", wf), ("black", "file", bf), ("white", "rank", wr), ("black", "rank", br)):
        got = (f[f"{side}_pawn_{axis}_mean"], f[f"{side}_pawn_{axis}_std"], f[f"{side}_pawn_{axis}_span"])
        assert got == pytest.approx(exp, abs=1e-5), (side, axis)


def test_invalid_positions_are_all_null(features):
    for i in range(len(INVALID)):
        f = features[100 + i]
        assert all(f[k] is None for k in FEATURE_KEYS), INVALID[i]


def test_feature_order(features):
    assert [k for k in features[0] if k != "id"] == FEATURE_KEYS


def test_start_position_reach_is_twenty(features):
    assert features[0]["white_piece_reach"] == 20 and features[0]["black_piece_reach"] == 20


def test_diffs_are_white_minus_black(features):
    f = features[1]
    assert f["material_diff"] == 2 and f["pawns_diff"] == 2 and f["isolated_pawns_diff"] == 1


def test_colour_mirror_swaps_sides(spark):
    fen = FENS["F2"].split(" ")[0]
    mirrored = "/".join(reversed(fen.split("/"))).swapcase()
    df = spark.createDataFrame([(1, fen), (2, mirrored)], "id long, fen string")
    rows = {r["id"]: r for r in B.position_features(B.board_decode(df, "fen", ["id"]), ["id"]).collect()}
    a, b = rows[1], rows[2]
    for k in FEATURE_KEYS:
        if k == "white_pawn_rank_mean":  # ranks flip: r -> 7 - r
            assert a[k] == pytest.approx(7 - b["black_pawn_rank_mean"])
        elif k.startswith("white_"):
            assert a[k] == pytest.approx(b["black_" + k[6:]]), k
        if k.endswith("_diff"):
            assert a[k] == pytest.approx(-b[k]), k


def test_fen_roundtrip(spark):
    df = spark.createDataFrame([(i, f) for i, f in enumerate(FENS.values())], "id long, fen string")
    pieces = B.board_decode(df, "fen", ["id"]).where("piece is not null")
    back = {r["id"]: r["fen"] for r in B.fen_encode(pieces, ["id"]).collect()}
    for i, f in enumerate(FENS.values()):
        if i == 2 or i == 3 or i == 1:
            assert back[i].split(" ")[0] == f.split(" ")[0]
