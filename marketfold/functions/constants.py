"""Fixed values that must equal the upstream collector's for equal results."""

# Spot products and their market keys.
SPOT_PRODUCTS = {"BTC-USD": "cb-btcusd", "ETH-USD": "cb-ethusd"}
# Prediction-market symbols, their market keys and slug prefixes.
PREDICTION_SYMBOLS = {"btc": "pm-btc", "eth": "pm-eth"}
SLUG_PREFIX = {"btc": "btc-updown-5m", "eth": "eth-updown-5m"}
# Venue names.
SPOT_VENUE = "coinbase"
PREDICTION_VENUE = "polymarket"
# Prediction-feed message types that carry no market data.
IGNORED_PREDICTION_TYPES = ("", "subscribed", "unsubscribed", "pong", "status")
# Outcome words naming the yes / no token.
YES_OUTCOMES = ("yes", "up")
NO_OUTCOMES = ("no", "down")
# Level-2 update sides that mean the bid book.
BID_SIDES = ("bid", "buy", "bids")
# Event kinds counted as book updates.
BOOK_KINDS = ("book_update", "book_snapshot", "quote")
# Rotated snapshot file name pattern.
ROTATED_FILE_RE = "^([a-z0-9-]+)__start_(\\d{8}T\\d{6}Z)__part_(\\d{4})\\.ndjson\\.zst$"
LEGACY_FILE_SUFFIX = ".ndjson.zst"
DATE_DIR_RE = "^\\d{4}-\\d{2}-\\d{2}$"
# Default slug bucket width (seconds) and sizing targets.
SLUG_BUCKET_SECONDS = 300
SIZE_TARGET_MB_PER_DAY = 5.0
ROTATE_THRESHOLD_BYTES = 3_800_000
INGEST_BATCH_SIZE = 250

# The market universe as rows: (market_key, venue, symbol or product).
MARKETS = (
    ("cb-btcusd", SPOT_VENUE, "BTC-USD"),
    ("cb-ethusd", SPOT_VENUE, "ETH-USD"),
    ("pm-btc", PREDICTION_VENUE, "btc"),
    ("pm-eth", PREDICTION_VENUE, "eth"),
)
