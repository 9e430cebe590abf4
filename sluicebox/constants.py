"""Values that the stored data depends on."""

# Results only stay comparable with existing layers if these do not change.
TOPIC_PATTERN = "bank_.*_transactions"
CLEAN_FEED_TOPIC = "cleaned_transactions_for_ml"

CLEAN = "CLEAN"
HARD_REJECT = "HARD_REJECT"
WARNING_MISSING_CONTEXT = "WARNING_MISSING_CONTEXT"
MISSING_AMOUNT = "MISSING_AMOUNT"
INVALID_VALUE = "INVALID_VALUE"
DEVICE_WARNING = "DEVICE_WARNING"

TRANSACTION_TIME_PATTERNS = ("dd/MM/yy HH:mm", "yyyy-MM-dd HH:mm:ss")
CARD_DIGEST_BITS = 256

FLAT_REQUIRED_FIELDS = ("transaction_id", "amount", "timestamp", "bank_id", "channel")
