"""Constants, patterns and wording that results depend on.

They are part of the data contract (what counts as a valid review, how a prompt
reads, how a score is weighted), so they are stated here once, as plain text.
"""

# Review record rules.
LANGUAGES = ("en", "fr", "de", "es", "it", "pt")
REVIEW_ID_PATTERN = "^rev-[0-9]{4}$"
PRODUCT_ID_PATTERN = "^prod-[0-9]{3}$"
RATING_MIN = 1
RATING_MAX = 5
TITLE_MAX = 120
BODY_MAX = 2000

# Dataset envelope and content library.
SCHEMA_VERSION = "1.0.0"
REVIEWS_KEY = "reviews"
PRODUCTS_MIN = 10
PRODUCTS_MAX = 15
PHRASES_MIN = 3
PHRASE_KINDS = ("titles", "sentences")
SENTIMENTS = ("positive", "neutral", "negative")
PRODUCT_PLACEHOLDER = "{product}"

# Routing and judging.
PASSTHROUGH_LANGUAGE = "en"
QUALITY_THRESHOLD = 3.0
SCALE_MIN = 1
SCALE_MAX = 5
NUMBER_PATTERN = r"-?\d+(?:\.\d+)?"
MAX_TOKENS = 512

# Prompts. Names in braces are filled from columns.
SUMMARY_PROMPT_HEAD = (
    "You are summarizing customer reviews for a single apparel product. "
    "Write a concise, 1-2 sentence product-level sentiment summary that "
    "captures the overall customer sentiment and the most common themes. "
    "Respond with only the summary text, no preamble.\n"
    "\n"
    "Product: {product_name}\n"
    "Number of reviews: {review_count}\n"
    "\n"
    "Reviews:"
)
SUMMARY_PROMPT_LINE = "{position}. (rating: {rating}) {title}: {body}"
MISSING_RATING = "N/A"
#: Half of a prompt at least is left for lines beside the head.
PROMPT_CHARS_MIN = 2000
SUMMARY_PROMPT_CONTINUED = "{position}. (continued) "
FAILED_SUMMARY = ""
JUDGE_PROMPT = (
    "You are a bilingual translation quality judge. Rate how well the "
    "translation preserves the meaning of the source (fidelity) and how "
    "naturally it reads in the target language (fluency).\n\n"
    "Source language: {source_language}\n"
    "Target language: {target_language}\n"
    "Source text:\n{source_text}\n\n"
    "Translation:\n{translated_text}\n\n"
    "Give a single overall score from {scale_min} to {scale_max} "
    "(where {scale_max} is a flawless translation and {scale_min} is "
    "unusable). Reply with the number only, no explanation."
)

# Round-trip similarity and report figures.
JACCARD_WEIGHT = 0.75
LENGTH_WEIGHT = 0.25
SIMILARITY_DECIMALS = 4
MEAN_DECIMALS = 3
PERCENT_DECIMALS = 1
MISSING_FIGURE = "–"

# Serving.
NOT_FOUND = "not_found"

# Synthetic data.
LANGUAGE_WEIGHTS = {"en": 0.40, "fr": 0.15, "de": 0.15, "es": 0.15, "it": 0.08, "pt": 0.07}
RATING_WEIGHTS = {5: 0.35, 4: 0.25, 3: 0.15, 2: 0.13, 1: 0.12}
POSITIVE_FROM = 4
NEUTRAL_AT = 3
BODY_SENTENCES_MIN = 1
BODY_SENTENCES_MAX = 3
