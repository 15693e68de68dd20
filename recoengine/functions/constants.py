"""Fixed values.

These lists must stay exactly as written: results depend on them.
"""

# ---- fixed values: Spark ML's default English stop words (StopWordsRemover,
# language "english"), 181 words in Spark's own order.  Kept here so the SQL
# oracle and the Spark plan use one list; tests assert it equals
# StopWordsRemover.loadDefaultStopWords("english").
ENGLISH_STOP_WORDS = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your",
    "yours", "yourself", "yourselves", "he", "him", "his", "himself", "she", "her",
    "hers", "herself", "it", "its", "itself", "they", "them", "their", "theirs",
    "themselves", "what", "which", "who", "whom", "this", "that", "these", "those",
    "am", "is", "are", "was", "were", "be", "been", "being", "have", "has", "had",
    "having", "do", "does", "did", "doing", "a", "an", "the", "and", "but", "if",
    "or", "because", "as", "until", "while", "of", "at", "by", "for", "with",
    "about", "against", "between", "into", "through", "during", "before", "after",
    "above", "below", "to", "from", "up", "down", "in", "out", "on", "off", "over",
    "under", "again", "further", "then", "once", "here", "there", "when", "where",
    "why", "how", "all", "any", "both", "each", "few", "more", "most", "other",
    "some", "such", "no", "nor", "not", "only", "own", "same", "so", "than", "too",
    "very", "s", "t", "can", "will", "just", "don", "should", "now", "i'll",
    "you'll", "he'll", "she'll", "we'll", "they'll", "i'd", "you'd", "he'd",
    "she'd", "we'd", "they'd", "i'm", "you're", "he's", "she's", "it's", "we're",
    "they're", "i've", "we've", "you've", "they've", "isn't", "aren't", "wasn't",
    "weren't", "haven't", "hasn't", "hadn't", "don't", "doesn't", "didn't",
    "won't", "wouldn't", "shan't", "shouldn't", "mustn't", "can't", "couldn't",
    "cannot", "could", "here's", "how's", "let's", "ought", "that's", "there's",
    "what's", "when's", "where's", "who's", "why's", "would",
)

# ---- fixed values: cleaning rules of the curation stages.
SENTINELS = ("", "N/A", "null")
AUTHOR_JUNK_PATTERN = "(?i)(review|amazon|page|chapter|purchase|bought|read this)"
CATEGORY_JUNK_PATTERN = "(?i)(review|amazon|page|chapter|purchase)"
BRACKET_CHARS_PATTERN = "[\\[\\]'\"]"
TITLE_KEY_DROP = "[^\\w\\s]"
TITLE_KEY_STRICT_DROP = "[^a-zA-Z0-9\\s]"

# ---- fixed values: sentiment rule constants (Hutto & Gilbert, ICWSM 2014).
NEGATION_SCALAR = -0.74
BOOSTER_INCREMENT = 0.293
BOOSTER_DECAY = (1.0, 0.95, 0.9)   # booster 1, 2 or 3 tokens before the word
NORMALIZATION_ALPHA = 15.0

# Our own short rule-word lists (not a published lexicon).
NEGATORS = (
    "not", "no", "never", "none", "nobody", "nothing", "neither", "nor",
    "nowhere", "cannot", "without", "isn't", "aren't", "wasn't", "weren't",
    "don't", "doesn't", "didn't", "won't", "wouldn't", "can't", "couldn't",
    "shouldn't", "hasn't", "haven't", "hadn't",
)
BOOSTERS_UP = (
    "very", "really", "extremely", "so", "too", "totally", "absolutely",
    "incredibly", "highly", "most", "more", "especially", "truly",
)
BOOSTERS_DOWN = (
    "barely", "hardly", "slightly", "somewhat", "less", "marginally", "scarcely",
)

# Emphasis rules of the published scorer (fixed values): capitals, contrast,
# exclamation and question marks.
CAPS_INCREMENT = 0.733
CONTRAST_WORDS = ("but",)
CONTRAST_BEFORE = 0.5
CONTRAST_AFTER = 1.5
EXCLAMATION_INCREMENT = 0.292
EXCLAMATION_MOST = 4
QUESTION_INCREMENT = 0.18
QUESTION_FEW = 3
QUESTION_MANY = 0.96
