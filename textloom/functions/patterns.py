"""Character classes and fixed word lists.

Regular expressions here use only what Java and RE2 read alike; ``\\w``, ``\\b`` and ``\\s`` are
ASCII in one or both, so words and spaces are spelled out with Unicode properties.
"""

# A word character: letter, number or underscore.
WORD_CHARS = r"\p{L}\p{N}_"
# Unicode white space: ASCII controls, NEL and every separator.
SPACE_CHARS = r"\t-\r\x{1c}-\x{20}\x{85}\p{Z}"

WORD = f"[{WORD_CHARS}]+"
SPACES = f"[{SPACE_CHARS}]+"
NON_SPACES = f"[^{SPACE_CHARS}]+"

URL_RUN = f"(http|www){NON_SPACES}"
HASHTAG = f"#{WORD}"
SPECIAL = f"[^{WORD_CHARS}{SPACE_CHARS}]"
NOT_LETTER = r"[^\p{L}]"
HAS_URL = f"(?i)(https?://|www\\.)[^{SPACE_CHARS}]"

# Emoji code-point ranges, in the order of the published list.
EMOJI_RANGES = (
    (0x1F600, 0x1F64F),
    (0x1F300, 0x1F5FF),
    (0x1F680, 0x1F6FF),
    (0x1F1E0, 0x1F1FF),
    (0x2700, 0x27BF),
    (0x1F900, 0x1F9FF),
    (0x2600, 0x26FF),
)
EMOJI = "[" + "".join(f"\\x{{{lo:X}}}-\\x{{{hi:X}}}" for lo, hi in EMOJI_RANGES) + "]"

# Letters whose runs are collapsed.
COLLAPSIBLE_LETTERS = (
    "a-zàáảãạăằắẳẵặâầấẩẫậèéẻẽẹêềếểễệìíỉĩịòóỏõọôồốổỗộơờớởỡợùúủũụưừứửữựỳýỷỹỵđ"
)

# Emoticon pattern and the word that replaces it, applied in this order.
EMOTICON_RULES = (
    (r"\(\(\(\(=", " cười "),
    (r":\)|:-\)|=\)", " cười "),
    (r":\(|:-\(|=\(", " buồn "),
)

# Vietnamese stop words.
VI_STOPWORDS = (
    "và", "là", "của", "có", "cho", "với", "một", "những", "các", "được", "trong", "khi", "đã", "này", "đó",
    "thì", "mà", "rằng", "vì", "nên", "ra", "vào", "đi", "đến", "tôi", "tao", "mày", "bạn", "anh", "chị", "em",
    "nó", "họ", "chúng", "mình", "ở", "theo", "từ", "lại", "rất", "quá", "thật", "không", "ko", "k", "để",
    "hay", "cũng", "đang", "sẽ", "bị", "do", "vẫn", "chỉ", "thôi", "đây", "kia", "ấy", "à", "ừ", "ờ", "ơi",
)

# Vietnamese stop words without accents, compared with match keys.
VI_STOPWORDS_ASCII = (
    "a", "ai", "anh", "ay", "bac", "ban", "bi", "cac", "cai", "chi", "cho", "chung", "co", "con", "cua", "cung",
    "da", "dang", "day", "de", "den", "di", "do", "duoc", "em", "hay", "ho", "k", "kia", "khi", "khong", "ko",
    "la", "lai", "ma", "may", "minh", "mot", "nay", "nen", "nha", "nhung", "no", "o", "oi", "qua", "ra", "rang",
    "rat", "se", "tao", "that", "theo", "thi", "thoi", "toi", "trong", "tu", "u", "va", "van", "vao", "vi", "voi",
)

# Slang as whole words, and slang patterns searched anywhere, for raw text.
SLANG_WORDS = (
    "ko", "k", "khum", "hok", "j", "z", "vk", "ck", "cmnr", "vl", "vcl", "lol", "lmao", "wtf", "dm", "đm",
    "clm", "cc", "kg", "hem", "hông", "đc", "dc", "ntn", "ib", "rep", "ad",
)
SLANG_MARKS = r"(?i)(:\)|=\)|:v)"

# Slang as whole words for match keys; laughter is a pattern over whole words.
SLANG_KEY_WORDS = (
    "ko", "k", "khum", "hok", "j", "z", "vk", "ck", "cmnr", "vl", "vcl", "lol", "lmao", "wtf", "dm",
    "clm", "cc", "kg", "hem", "hong", "dc", "ntn", "ib", "rep", "ad",
)
SLANG_KEY_LAUGHS = r"(^| )(kaka+|hihi+|he ?he)( |$)"

# Common function words of the languages in the generated test tables.
LATIN_STOPWORDS = (
    "the", "and", "of", "to", "in", "is", "it", "that", "for", "with", "as", "on", "at", "or", "not",
    "le", "la", "les", "un", "une", "des", "du", "et", "que", "qui", "pour", "dans", "avec", "pas", "est",
    "der", "die", "das", "und", "ein", "eine", "nicht", "mit", "von", "für", "auf", "den", "dem", "sich", "ist",
    "el", "los", "las", "una", "y", "en", "por", "con", "para", "no", "se", "lo", "como", "del", "al",
)
