"""Values of the DuckDB SQL, written apart from those the library computes with.

A slip in either file shows as a difference between a query and its SQL.
"""

# Word lists and emoji of the two sentiment schemes.
POSITIVE_WORDS = """
    love loved loving great amazing awesome excellent good best happy wonderful fantastic
    brilliant perfect beautiful incredible outstanding superb magnificent thank thanks grateful
    appreciate excited joy blessed recommend recommended favorite favourite impressive
""".split()
NEGATIVE_WORDS = """
    hate hated hating bad terrible awful worst horrible angry sad disappointed disappointing
    frustrating frustrated annoying annoyed useless waste poor pathetic disgusting ugly stupid
    boring fail failed failing sucks broken scam fake trash garbage nightmare disappoints
""".split()
POSITIVE_EMOJI = "😊 😍 ❤️ 👍 🎉 💯 🙏 😁 🔥 💪".split()
NEGATIVE_EMOJI = "😢 😡 👎 💔 😤 🤮 😭 😠 🙄".split()
POSITIVE_INDICATORS = """
    love great amazing awesome excellent good best happy wonderful fantastic brilliant perfect
    thank ❤️ 😊 👍 🎉 💯 🙏 😍 🔥
""".split()
NEGATIVE_INDICATORS = """
    hate bad terrible awful worst horrible angry sad disappointed frustrating annoying useless
    😢 😡 👎 💔 😤 🤮
""".split()

# Engagement thresholds (medium, high, viral) and comment weights.
ETL_THRESHOLDS = {
    "instagram": (500, 5000, 50000), "youtube": (1000, 10000, 100000),
    "twitter": (100, 1000, 10000), "reddit": (100, 1000, 10000),
}
ETL_COMMENT_WEIGHT = 3
LABELER_THRESHOLDS = {
    "instagram": (100, 1000, 10000), "youtube": (1000, 10000, 100000),
    "twitter": (50, 500, 5000), "reddit": (100, 1000, 10000),
}

# Entities in their order of decoding, and plain forms of characters.
ENTITIES = [("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#x200B;", "")]
REDDIT_ENTITIES = [("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&#x200B;", "")]
QUOTES_AND_DASHES = [("‘", "'"), ("’", "'"), ("“", '"'), ("”", '"'), ("–", "-"), ("—", "--")]
ZERO_WIDTH = [(chr(0x200B), ""), (chr(0xFEFF), "")]
NO_BREAK_SPACE = [(chr(0xA0), " ")]

# Patterns in the syntax of DuckDB's engine.
WORD = r"[\pL\pN_]"
_WHITE = r" \t\n\x{0b}\f\r\x{1c}\x{1d}\x{1e}\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
SPACE = f"[{_WHITE}]"
HASHTAG = f"#({WORD}+)"
HASHTAG_TAIL = f"#{WORD}+{SPACE}*"
MENTION = f"@{WORD}+"
URL = rf"https?://[^{_WHITE}]+|www\.[^{_WHITE}]+"
EMOJI_RUN = r"[\x{24C2}-\x{1F251}\x{1F300}-\x{1F64F}\x{1F680}-\x{1F6FF}]+"
