"""Fixed values that results depend on."""

# Promotional markers, removed in this order.
MARKERS = (
    "【福利秒杀】",
    "【每日福利】",
    "【福利爆款】",
    "【专柜品质】",
    "【1元秒杀】",
    "【直播专用1元秒杀】",
    "【",
    "】",
    "源本",
)

# Bracket span, and the white space that Python's str.strip removes.
BRACKET_SPAN = r"\[[^()]*\]"
WHITESPACE = (
    r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)

# Special tokens, in id order.
PAD, UNK, CLS, SEP = "[PAD]", "[UNK]", "[CLS]", "[SEP]"
SPECIAL_TOKENS = (PAD, UNK, CLS, SEP)
PAD_ID, UNK_ID, CLS_ID, SEP_ID = 0, 1, 2, 3

# Job defaults.
ON_SHELF = "UP"
KEY_PREFIX = "dj_similar"
TTL_SECONDS = 7 * 24 * 3600
NEIGHBOURS = 12
DEEP_DIM = 1024
BASELINE_DIM = 300
N_CLASSES = 31
MARGIN_SCALE = 64.0
MARGIN = 0.40
MAX_LEN = 512
MAX_LEN_TRAIN = 128
MAX_LEN_INFER = 50
BATCH_SIZE = 128
LEARNING_RATE = 1e-5
WEIGHT_DECAY = 1e-4
WARMUP = 0.25
DROPOUT = 0.1
SEED = 1000
EPOCHS = 500
LOG_EVERY = 10
SAVE_EVERY = 100
EPS_NORM = 1e-12
