"""Values fixed by the data model: results are only right when these are exactly as stated."""

# Short first names and the long form that is tried as well.
NICKNAMES = {
    "chris": "christopher",
    "ben": "benjamin",
    "mike": "michael",
    "joe": "joseph",
    "md": "mohammed",
    "mohd": "mohammed",
    "dan": "daniel",
    "matt": "matthew",
    "steve": "steven",
    "tim": "timothy",
    "sam": "samuel",
    "nick": "nicholas",
    "greg": "gregory",
    "mark": "marcus",
    "john": "johnny",
}

# Dismissals that are not the bowler's. "retired out" is listed by the data model as a kind and
# is not the bowler's either; UNCREDITED_KINDS_NARROW leaves it out, for comparison with older loads.
UNCREDITED_KINDS_NARROW = ["run out", "obstructing the field", "retired hurt", "handled the ball", "timed out"]
UNCREDITED_KINDS = UNCREDITED_KINDS_NARROW + ["retired out"]

# The allowed answers of an attribute reply.
BATTING_HANDS = ["Right-hand bat", "Left-hand bat"]
BOWLING_HANDS = ["Right-arm", "Left-arm"]
PLAYER_ROLES = ["Batsman", "Bowler", "All-rounder", "Wicket Keeper"]
BOWLING_STYLES = [
    "RF/RAF", "RFM/RAFM", "RMF/RAMF", "RM/RAM", "RMS/RAMS", "RSM/RASM", "RS/RAS",
    "LF/LAF", "LFM/LAFM", "LMF/LAMF", "LM/LAM", "LMS/LAMS", "LSM/LASM", "LS/LAS",
    "OB", "LB", "LBG",
    "SLA", "SLW", "LAG",
]
UNKNOWN = "N/A"
UNKNOWN_BIRTH_DATE = "1900-01-01"

# Each half of a paired style ("RF", "RAF") means the pair ("RF/RAF").
STYLE_PAIRS = {half: style for style in BOWLING_STYLES if "/" in style for half in style.split("/")}

# Words before the last one that belong to the family name.
NAME_PARTICLES = ["de", "du", "al", "ul"]
NAME_PARTICLE_PAIRS = ["van der"]

# Words that may not occur in a read-only query text.
BLOCKED_WORDS = [
    "drop", "delete", "insert", "update", "truncate", "alter", "create", "grant", "revoke",
    "exec", "execute", "pg_sleep", "waitfor", "dbms_lock",
]

# Player attributes filled by enrichment, and the smaller set that marks a row as unresolved.
PLAYER_ATTRIBUTES = [
    "batting_hand", "bowling_hand", "bowling_style", "date_of_birth", "country", "player_role", "full_name",
]
TEXT_ATTRIBUTES = ["batting_hand", "bowling_hand", "player_role", "country", "bowling_style"]

# Sizes of shaped results.
TOP_SLICES = 12
PIE_SLICES = 10
HISTOGRAM_BINS = 30
DEFAULT_ROWS = 10
MAX_ROWS = 100
