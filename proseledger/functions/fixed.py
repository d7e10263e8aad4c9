"""Fixed values. Results depend on each of these being exactly as it is."""

# --- Fixed values: extraction patterns (group 1 is the extracted field) ---
EMAIL = r"([a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,})"
PHONE = r"(\(\d{3}\)\s?\d{3}-\d{4})"
DATE = r"(\d{4}-\d{2}-\d{2})"
ORDER_REF = r"(?:Order|Invoice|INV)[\s#:-]*([A-Z]{2,4}[-_#]?[A-Z0-9]{3,10})"
CARD = r"\b\d{4}[-\s]?\d{4}[-\s]?\d{4}[-\s]?\d{4}\b"
IP_ADDRESS = r"\b(\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})\b"
AMOUNT = r"\$(\d{1,3}(?:,\d{3})*\.?\d{0,2})"
ERROR_CODE = r"(?:ERR|Error)[\s:-]*([A-Z]{2,4}-?\d{3,5})"

# --- Fixed value: replacement for a card number (the last four digits are not kept) ---
CARD_MASK = "XXXX-XXXX-XXXX-####"

# --- Fixed values: sentiment words, whole and case-sensitive ---
POSITIVE_WORDS = ("great", "good", "excellent", "amazing", "best")
NEGATIVE_WORDS = ("bad", "poor", "terrible", "awful", "worst")

# --- Fixed value: what separates sentences ---
SENTENCE_END = r"[.!?]+"

# --- Fixed values: buckets as (upper bounds, labels); a value below bound i gets label i ---
LENGTH_3 = ((100, 500), ("Short", "Medium", "Long"))
LENGTH_5 = ((100, 300, 700, 1500), ("Very Short", "Short", "Medium", "Long", "Very Long"))
RATING_4 = ((7, 8, 9), ("Poor", "Fair", "Good", "Excellent"))

# --- Fixed values: correlation strength by absolute value, strongest first ---
CORRELATION_STRENGTH = ((0.7, "Strong"), (0.3, "Moderate"), (0.1, "Weak"))
