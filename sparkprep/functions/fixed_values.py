"""Fixed values that must equal the behaviour being reproduced.

FIXED VALUES — keyword lists, ordered rule tables, category maps, sentinel
texts and model constants. They are data, stated in their natural order; the
order of every rule list is load-bearing (first match wins).
"""

# ---------------------------------------------------------------- FIXED VALUES
# Access flags: (output column, alternation over lower-cased text).
ACCESS_FLAGS = [
    ("parking", "parking"),
    ("pets_allowed", "pets allowed|pets live on this property"),
    ("private_entrance", "private entrance"),
    ("kitchen_access", "kitchen"),
    ("smoke_free", "no smoking|smoke free"),
    ("event_friendly", "suitable for events"),
    ("full_access", "all of the home is accessible|full access"),
]

# Host location -> region; first match wins, default "Other".
REGION_RULES = [
    ("northeast|new york|massachusetts|new jersey|connecticut|pennsylvania", "Northeast US"),
    ("southeast|florida|georgia|north carolina|south carolina", "Southeast US"),
    ("midwest|illinois|ohio|michigan|indiana|wisconsin|missouri", "Midwest US"),
    ("southwest|texas|arizona|new mexico|oklahoma", "Southwest US"),
    ("west|california|nevada|oregon|washington|colorado", "West US"),
    ("canada|europe|asia|africa|australia|latin america", "International"),
]
REGION_DEFAULT = "Other"

# Jurisdiction names -> state; a rule may be a list of patterns that must all
# match. First match wins, default "Other".
JURISDICTION_RULES = [
    ("california|los angeles|malibu|santa monica|palo alto", "California"),
    ("louisiana|new orleans", "Louisiana"),
    ("washington|district of columbia", "Washington DC"),
    ("oregon|multnomah|portland|lane county|washington county", "Oregon"),
    ("illinois|chicago|cook county|oak park", "Illinois"),
    ("arkansas", "Arkansas"),
    ("connecticut", "Connecticut"),
    ("colorado", "Colorado"),
    (["montgomery county", "md"], "Maryland"),
]
JURISDICTION_DEFAULT = "Other"

# Keyword categorisers: the label is the keyword itself, default "other".
DESCRIPTION_KEYWORDS = ["private", "kitchen", "restaurants", "access", "space",
                        "full", "walk", "great", "park", "new"]
OVERVIEW_KEYWORDS = ["restaurants", "park", "walk", "great", "bars", "walking",
                     "blocks", "shops", "city", "downtown"]
TRANSIT_KEYWORDS = ["bus ", "walk", "train", "downtown", "metro", "subway",
                    "station", "airport", "public", "min"]
INTERACTION_KEYWORDS = ["available", "guests", "need", "stay", "questions", "help",
                        "happy", "time", "anything", "around", "email", "please",
                        "answer", "love", "call", "reccomendations", "provide"]
KEYWORD_DEFAULT = "other"

# Host self-description topics: (alternation over lower-cased text, label).
HOST_MENTION_RULES = [
    ("travel|exploring|adventure|places|beach|city|san|york|francisco|la|nyc|austin|angeles|boston|chicago|seattle|portland|diego|nashville|dc|california|europe|paris|london|mexico|france|spain|italy",
     "Travel and Locations"),
    ("home|house|apartment|cozy|living|stay|comfortable|space|room|property|furnished|interior",
     "Home and Living"),
    ("music|art|movies|books|entertainment|sports|dancing|shows|film|theater|concerts|festivals|party",
     "Social and Entertainment"),
    ("food|cooking|eating|cuisine|restaurants|coffee|dining|wine|dinner|meals|cook|chef",
     "Food and Cooking"),
    ("hiking|outdoors|beach|park|nature|garden|mountains|walking|biking|running|fishing|camping",
     "Outdoor and Adventure"),
    ("business|professional|work|job|company|industry|office|career|entrepreneur|management",
     "Professional and Business"),
    ("family|friends|kids|husband|wife|daughter|son|guests|host|meeting|community|social",
     "Family and Relationships"),
    ("culture|lifestyle|history|tradition|heritage|fashion|style|design|modern|vintage|arts",
     "Culture and Lifestyle"),
    ("health|wellness|fitness|yoga|meditation|exercise|gym|sports|diet|healthy",
     "Health and Well-being"),
    ("learning|education|school|university|classes|courses|teaching|teacher|student|training|knowledge",
     "Education and Learning"),
]
HOST_MENTION_DEFAULT = "Other"

# Property type -> property category; anything else (and null) -> "other".
PROPERTY_CATEGORIES = [
    (["Apartment", "Serviced apartment", "Loft"], "apartment"),
    (["Bed & Breakfast", "Boutique hotel", "Hostel"], "hotel"),
    (["Townhouse", "Condominium"], "condo"),
    (["Bungalow", "House"], "house"),
]
PROPERTY_DEFAULT = "other"

# Cancellation policies merged into "strict"; others kept, null stays null.
STRICT_POLICIES = ["strict", "super_strict_30"]

# Neighbourhood merge and bed type.
NEIGHBORHOOD_MERGE = ("La Jolla Village", "La Jolla")
REAL_BED = "Real Bed"

# House-rule topics and prohibition/permission words.
RULE_TOPICS = ["smoking", "pets"]
RULE_WORDS = ["allowed", "no"]

# Space-word keywords.
SPACE_KEYWORDS = ["balcony", "bedroom", "kitchen", "bathroom"]

# Exploratory chart parameters: 2-D density bins, histogram breaks and the
# San Francisco Bay Area window (lon_min, lon_max, lat_min, lat_max).
BIN2D_BINS = 100
HIST_BREAKS = 10
BAY_AREA_BOUNDS = (-123.0, -121.5, 37.0, 38.5)

# Sentinels and constants.
NOT_MENTIONED = "Not Mentioned"
MISSING_CITY = "Missing"
MISSING_TOKEN = "missing_value_placeholder"
SENTINEL_DATE = "1999-01-01"
REFERENCE_DATE = "2000-01-01"
LICENSE_PENDING = "pending"
CLASS_WEIGHTS = {"NO": 1.5, "YES": 3.5}
BOOST_POS_WEIGHT = 0.72
VOCAB_TERM_MAX = 500
KNN_K = 13
CV_FOLDS = 15
SPLIT_SEED = 123
VALID_FRACTION = 0.30
FINAL_FRACTION = 0.10
TRAIN_SIZES = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]
FOREST_TREES = 600
FOREST_MTRY = 13  # sqrt(185) truncated
THRESHOLDS = {"forest": 0.46, "enriched_forest": 0.45, "default": 0.5}

# Default English stop-word list shipped with Spark ML's StopWordsRemover.
ENGLISH_STOP_WORDS = [
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
]

# Features dropped before modelling, and the target not modelled.
PRUNED_FEATURES = ["host_neighbourhood", "neighborhood", "city", "market",
                   "smart_location", "cancellation_policy", "has_space_features",
                   "jurisdiction_state", "desc_category"]
SECOND_TARGET = "high_booking_rate"

# Weight of positive rows for the leaf-wise booster.
LEAFWISE_POS_WEIGHT = 0.9

# Boosting rounds without gain before it stops.
PATIENCE = 15
# ------------------------------------------------------------ END FIXED VALUES
