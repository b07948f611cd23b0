"""Fixed values that results depend on.

These names, orders and constants define the data model; they must stay equal
to the ones the original analysis uses for results to line up.
"""

from pyspark.sql import types as T

# --- fixed values: the 16 game columns, in file order -----------------------
GAME_COLUMNS = [
    "WhiteElo", "BlackElo", "WhiteName", "BlackName", "Winner", "Termination",
    "Site", "Day", "Month", "Year", "InitialTime", "Increment", "TimeControl",
    "Opening", "ECO", "Number_of_Moves",
]

# --- fixed values: snapshot depths in full moves ------------------------------
OPENING_MOVES = 10
MIDGAME_MOVES = 20

# --- fixed values: the 43 position features, in output order -----------------
# The last three are the per-side mobility slots; this engine fills them with
# pseudo-legal piece reach (see pawnshop.operators.board.piece_reach).
FEATURE_KEYS = [
    "material_white", "material_black", "material_diff",
    "white_pawns", "white_doubled_pawns", "white_isolated_pawns",
    "white_passed_pawns", "white_advanced_pawns", "white_pawn_islands",
    "black_pawns", "black_doubled_pawns", "black_isolated_pawns",
    "black_passed_pawns", "black_advanced_pawns", "black_pawn_islands",
    "pawns_diff", "passed_pawns_diff", "advanced_pawns_diff",
    "isolated_pawns_diff", "pawn_islands_diff",
    "white_king_pawn_shield", "white_king_pawns_near",
    "black_king_pawn_shield", "black_king_pawns_near",
    "king_pawn_shield_diff", "king_pawns_near_diff",
    "white_pawn_file_mean", "white_pawn_file_std", "white_pawn_rank_mean",
    "white_pawn_rank_std", "white_pawn_file_span", "white_pawn_rank_span",
    "black_pawn_file_mean", "black_pawn_file_std", "black_pawn_rank_mean",
    "black_pawn_rank_std", "black_pawn_file_span", "black_pawn_rank_span",
    "pawn_file_std_diff", "pawn_rank_std_diff",
    "white_piece_reach", "black_piece_reach", "piece_reach_diff",
]

# --- fixed values: material per piece letter (king counts 0) -------------------
PIECE_VALUE = {"P": 1, "N": 3, "B": 3, "R": 5, "Q": 9, "K": 0}

# --- fixed values: quartile labels of the rating bins, low to high -----------
QUARTILE_LABELS = ["Bajo", "Medio-Bajo", "Medio-Alto", "Alto"]

# --- fixed values: thresholds scanned for the decision rule -------------------
THRESHOLDS = [0.3, 0.4, 0.5, 0.6, 0.7]

PHASES = {"open": "open_", "mid": "", "final": "final_"}

FEATURE_SCHEMA = T.StructType([T.StructField(k, T.DoubleType(), True) for k in FEATURE_KEYS])

GAME_SCHEMA_RAW = T.StructType([T.StructField(c, T.StringType(), True) for c in GAME_COLUMNS])

GAME_SCHEMA = T.StructType([
    T.StructField("WhiteElo", T.DoubleType()), T.StructField("BlackElo", T.DoubleType()),
    T.StructField("WhiteName", T.StringType()), T.StructField("BlackName", T.StringType()),
    T.StructField("Winner", T.StringType()), T.StructField("Termination", T.StringType()),
    T.StructField("Site", T.StringType()), T.StructField("Day", T.IntegerType()),
    T.StructField("Month", T.IntegerType()), T.StructField("Year", T.IntegerType()),
    T.StructField("InitialTime", T.IntegerType()), T.StructField("Increment", T.IntegerType()),
    T.StructField("TimeControl", T.StringType()), T.StructField("Opening", T.StringType()),
    T.StructField("ECO", T.StringType()), T.StructField("Number_of_Moves", T.StringType()),
])
