"""Values that have to equal the published ones for results to agree. Data only, no logic."""

# fixed values: keywords of the keyword scorer (unaccented, matched as substrings)
POSITIVE_KEYWORDS = (
    "hay", "tot", "xuat sac", "cam on", "thich", "yeu", "dep", "tuyet",
    "awesome", "great", "good", "useful",
)
NEGATIVE_KEYWORDS = (
    "chan", "te", "do", "khong thich", "that vong", "toi", "met",
    "bad", "terrible", "boring", "poor",
)

# fixed values: sentiment labels, in tie-breaking order
SENTIMENTS = ("positive", "neutral", "negative")

# fixed values: label spellings of common classifiers
LABEL_SPELLINGS = {
    "positive": ("positive", "pos", "label_2", "2"),
    "neutral": ("neutral", "neu", "label_1", "1"),
    "negative": ("negative", "neg", "label_0", "0"),
}

# fixed values: fields every incoming record must fill
REQUIRED_FIELDS = (
    "event_time", "collected_at", "comment_id", "video_id", "author", "text",
    "like_count", "reply_count", "is_reply", "source",
)

# fixed values: spellings of true
TRUE_SPELLINGS = ("1", "true", "yes", "y", "on")

# fixed values: time layout of incoming JSON, lateness allowed in Silver
RECORD_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ssX"
LATENESS = "2 days"

# fixed values: patterns of links, escapes written out, and stretched letters
LINK = r"https?://\S+|www\.\S+"
ESCAPE = r"\\u[0-9a-fA-F]{4}|\\U[0-9a-fA-F]{8}"
STRETCH = r"([a-z])\1{2,}"
STRETCHED_WORD = r"^[a-z]*([a-z])\1{2,}[a-z]*$"

# fixed values: hosts whose links carry a video id, and the source name of API records
WATCH_HOST = "youtube.com"
SHORT_HOST = "youtu.be"
API_SOURCE = "youtube_api"

# fixed values: slang lexicon as (term, replacement, sentiment hint)
SLANG = (
    ("common w", "awesome win", "positive"),
    ("massive w", "amazing win", "positive"),
    ("huge w", "amazing win", "positive"),
    ("big w", "great win", "positive"),
    ("w", "awesome win", "positive"),
    ("common l", "bad loss", "negative"),
    ("massive l", "terrible loss", "negative"),
    ("huge l", "terrible loss", "negative"),
    ("big l", "bad loss", "negative"),
    ("l", "bad loss", "negative"),
    ("goated", "greatest of all time amazing", "positive"),
    ("goat", "greatest of all time amazing", "positive"),
    ("fire", "amazing awesome", "positive"),
    ("lit", "exciting awesome", "positive"),
    ("peak", "excellent amazing", "positive"),
    ("valid", "good approved", "positive"),
    ("slay", "amazing stylish", "positive"),
    ("ate that", "performed amazingly", "positive"),
    ("ate", "performed amazingly", "positive"),
    ("iconic", "memorable amazing", "positive"),
    ("king", "amazing respected", "positive"),
    ("queen", "amazing respected", "positive"),
    ("lets goo", "excited awesome", "positive"),
    ("lets go", "excited awesome", "positive"),
    ("omg", "oh my god amazing", "positive"),
    ("no way", "surprised amazing", "positive"),
    ("no way impossible", "unbelievable amazing", "positive"),
    ("ain't no way", "shocked disbelief", "neutral"),
    ("crazyyy", "crazy amazing", "positive"),
    ("crazy", "surprising intense", "neutral"),
    ("wild", "surprising intense", "neutral"),
    ("insane", "extremely amazing", "positive"),
    ("frfr", "for real", "neutral"),
    ("fr", "for real", "neutral"),
    ("ngl", "honestly", "neutral"),
    ("imo", "in my opinion", "neutral"),
    ("imho", "in my humble opinion", "neutral"),
    ("lmao", "laughing hard", "positive"),
    ("lmfao", "laughing hard", "positive"),
    ("lol", "laughing", "positive"),
    ("gg", "good game", "positive"),
    ("ez", "easy win", "positive"),
    ("no cap", "seriously true", "neutral"),
    ("cap", "lie", "negative"),
    ("ragebaiter", "provocative annoying person", "negative"),
    ("ragebait", "provocation anger", "negative"),
    ("bait", "provocation", "negative"),
    ("cooked him", "defeated badly", "negative"),
    ("cooked", "in trouble bad", "negative"),
    ("washed", "bad finished", "negative"),
    ("clapped", "defeated badly", "negative"),
    ("dogwater", "terrible bad", "negative"),
    ("garbage", "terrible bad", "negative"),
    ("trash", "terrible bad", "negative"),
    ("mid", "average disappointing", "negative"),
    ("cringe", "embarrassing bad", "negative"),
    ("sus", "suspicious weird", "negative"),
    ("glaze", "excessive praise", "negative"),
    ("fumbled", "made a mistake", "negative"),
    ("humbled", "defeated badly", "negative"),
    ("npc", "boring robotic person", "negative"),
    ("based", "cool admirable", "positive"),
    ("stan", "strong supporter", "positive"),
    ("bro", "friend", "neutral"),
    ("bruh", "disbelief", "neutral"),
    ("my boi", "my friend awesome", "positive"),
    ("niceeeee", "nice awesome", "positive"),
    ("niceeee", "nice awesome", "positive"),
    ("niceee", "nice awesome", "positive"),
    ("justice for", "unfair complaint", "negative"),
    ("0 like", "ignored sad", "negative"),
    ("❤", "love", "positive"),
    ("❤️", "love", "positive"),
    ("\U0001f525", "awesome", "positive"),
    ("\U0001f389", "celebration", "positive"),
    ("\U0001f602", "laughing joy", "positive"),
    ("\U0001f923", "laughing joy", "positive"),
    ("\U0001f60a", "happy", "positive"),
    ("\U0001f60d", "love", "positive"),
    ("\U0001f631", "shocked", "neutral"),
    ("\U0001f62e", "surprised amazing", "positive"),
    ("\U0001f622", "sad", "negative"),
    ("\U0001f62d", "crying sad", "negative"),
    ("\U0001f61f", "disappointed sad", "negative"),
    ("\U0001f641", "disappointed sad", "negative"),
    ("\U0001f494", "heartbreak sad", "negative"),
    ("\U0001f97a", "pleading sad", "negative"),
)
