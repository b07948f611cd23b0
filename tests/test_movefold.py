"""The folds within a game's row against windows over its half-moves, and their plans."""

import random

import pytest

from pawnshop.operators import movefold as MF, moves as M
from pawnshop.plans.common import rounded
from tests.test_moves_golden import GAMES

ODD = [(20, "e4 ) e5 ( d4 ( e6 ) Nf3 ) Nc6 ( ( a3 )"), (21, ") ( x ) ( e4 1-0 e5"), (22, "(e4) e5 (((d4)) d5 ) c4 * c5"), (23, "\n e4\n(a)b3 Nf6"),
       (24, ""), (25, "1.e4 2...e5! (x 1-0) Nf3+!? 0-1 d4"), (26, "1. 12...e4e5 Nf3x a9 0-0-0# O-O+ bxa8=Q cxd1N ; d4\nd4 {a} $3 [x] a4"),
       (27, "a4 b5 axb6 cxb6 a4 a5 b4 axb3")]


def _random_games(seed, n):
    rng = random.Random(seed)
    out = []
    for g in range(n):
        words = []
        for _ in range(rng.randrange(200)):
            f, r = rng.choice("abcdefgh"), rng.randrange(1, 9)
            words.append(rng.choice([f"{f}{r}", f"{f}{r}", f"{rng.choice('abcdefgh')}x{f}{r}", f"{rng.choice('NBRQK')}{f}{r}", f"{rng.choice('NBRQK')}x{f}{r}",
                                     f"{f}8=Q", "O-O", "O-O-O", "(", ")", "{x}", "1.", "junk"]))
        out.append((100 + g, " ".join(words)))
    return out


@pytest.fixture(scope="module")
def games(spark):
    return spark.createDataFrame(GAMES + ODD + _random_games(3, 60), "game_id long, movetext string").cache()


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("name", ["movetext_tokens", "total_moves", "material_timeline"])
def test_folds_equal_windows(games, name):
    assert _rows(getattr(MF, name)(games, "game_id", "movetext")) == _rows(getattr(M, name)(games, "game_id", "movetext"))


def test_squares_and_features_equal_windows(games):
    events = M.resolved_events(games, "game_id", "movetext").cache()
    assert _rows(MF.king_squares(games, "game_id", "movetext")) == _rows(M.king_square_at(events, "game_id"))
    assert _rows(MF.pawn_squares(games, "game_id", "movetext")) == _rows(M.pawn_squares_at(events, "game_id"))
    assert _rows(rounded(MF.game_position_features(games, "game_id", "movetext"))) == _rows(rounded(M.game_position_features(games, "game_id", "movetext")))


@pytest.mark.parametrize("phases", [{"final": None}, {"early": 3, "late": 100}, {"final": None, "start": 0, "one": 1}])
def test_any_phases(games, phases):
    events = M.resolved_events(games, "game_id", "movetext").cache()
    assert _rows(MF.pawn_squares(games, "game_id", "movetext", phases)) == _rows(M.pawn_squares_at(events, "game_id", phases))


def test_nothing_is_shuffled(spark):
    games = spark.createDataFrame(GAMES, "game_id long, movetext string")
    for f in (MF.movetext_tokens, MF.total_moves, MF.material_timeline, MF.game_position_features, MF.king_squares, MF.pawn_squares):
        plan = f(games, "game_id", "movetext")._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Window" not in plan
