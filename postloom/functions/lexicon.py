"""Word lists, emoji, thresholds, patterns and replacements.

These are data the labels and cleaners are defined by; results depend on every
entry being exactly as stated.
"""

# Positive and negative words of the word-set sentiment.
POSITIVE_WORDS = [
    "love", "loved", "loving", "great", "amazing", "awesome", "excellent",
    "good", "best", "happy", "wonderful", "fantastic", "brilliant", "perfect",
    "beautiful", "incredible", "outstanding", "superb", "magnificent",
    "thank", "thanks", "grateful", "appreciate", "excited", "joy", "blessed",
    "recommend", "recommended", "favorite", "favourite", "impressive",
]
NEGATIVE_WORDS = [
    "hate", "hated", "hating", "bad", "terrible", "awful", "worst", "horrible",
    "angry", "sad", "disappointed", "disappointing", "frustrating", "frustrated",
    "annoying", "annoyed", "useless", "waste", "poor", "pathetic", "disgusting",
    "ugly", "stupid", "boring", "fail", "failed", "failing", "sucks", "broken",
    "scam", "fake", "trash", "garbage", "nightmare", "disappoints",
]

# Emoji counted by the word-set sentiment.
POSITIVE_EMOJI = ["😊", "😍", "❤️", "👍", "🎉", "💯", "🙏", "😁", "🔥", "💪"]
NEGATIVE_EMOJI = ["😢", "😡", "👎", "💔", "😤", "🤮", "😭", "😠", "🙄"]

# Substrings counted by the substring sentiment.
POSITIVE_INDICATORS = [
    "love", "great", "amazing", "awesome", "excellent", "good", "best",
    "happy", "wonderful", "fantastic", "brilliant", "perfect", "thank",
    "❤️", "😊", "👍", "🎉", "💯", "🙏", "😍", "🔥",
]
NEGATIVE_INDICATORS = [
    "hate", "bad", "terrible", "awful", "worst", "horrible", "angry",
    "sad", "disappointed", "frustrating", "annoying", "useless",
    "😢", "😡", "👎", "💔", "😤", "🤮",
]

# Engagement thresholds (medium, high, viral) per platform, and
# the weight of a comment, for the two label schemes. A platform that is not
# listed uses the twitter row.
ETL_THRESHOLDS = {
    "instagram": (500, 5000, 50000),
    "youtube": (1000, 10000, 100000),
    "twitter": (100, 1000, 10000),
    "reddit": (100, 1000, 10000),
}
ETL_COMMENT_WEIGHT = 3
LABELER_THRESHOLDS = {
    "instagram": (100, 1000, 10000),
    "youtube": (1000, 10000, 100000),
    "twitter": (50, 500, 5000),
    "reddit": (100, 1000, 10000),
}
LABELER_COMMENT_WEIGHT = 2

# HTML entities, decoded in this order.
ENTITIES = [
    ("&amp;", "&"),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&#x200B;", ""),
]
REDDIT_ENTITIES = [("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&#x200B;", "")]

# Typographic characters and their plain forms.
QUOTES_AND_DASHES = [
    ("\u2018", "'"),
    ("\u2019", "'"),
    ("\u201c", '"'),
    ("\u201d", '"'),
    ("\u2013", "-"),
    ("\u2014", "--"),
]
ZERO_WIDTH = [("\u200b", ""), ("\ufeff", "")]
NO_BREAK_SPACE = [("\u00a0", " ")]

# Character classes. Word characters and whitespace are the
# Unicode sets, spelled out because the regex engine's own \w and \s are ASCII.
WORD = r"[\p{L}\p{N}_]"
# Whitespace other than the plain space, the space, and everything else.
_RARE = r"\t-\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
RARE_SPACE = f"[{_RARE}]"
SPACE = f"[ {_RARE}]"
NON_SPACE = f"[^ {_RARE}]"
SPACE_CHARACTERS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
# Emoticons, symbols, transport, flags and everything from U+24C2 to U+1F251.
EMOJI = r"[\x{24C2}-\x{1F251}\x{1F300}-\x{1F64F}\x{1F680}-\x{1F6FF}]"
EMOJI_RUN = f"{EMOJI}+"

HASHTAG = f"#({WORD}+)"
HASHTAG_TAIL = f"#{WORD}+{SPACE}*"
MENTION = f"@{WORD}+"
URL = rf"https?://{NON_SPACE}+|www\.{NON_SPACE}+"

# Image extensions kept in thumbnail names; others become jpg.
IMAGE_EXTENSIONS = ["jpg", "jpeg", "png", "webp", "gif", "heic"]
