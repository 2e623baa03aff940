"""Word lists, tables and patterns that results depend on. Their order matters where a scan takes the first hit."""

# Product-type stems and their buckets, in scanning order.
PRODUCT_STEMS = [
    ("крем-основа", "foundation_base"), ("гель-крем", "cream"), ("парфюмерн", "perfume"), ("туалетн", "perfume"), ("одеколон", "perfume"),
    ("духи", "perfume"), ("маскар", "mascara"), ("туш", "mascara"), ("крем", "cream"), ("сыворот", "serum"), ("эмульси", "lotion"),
    ("лосьон", "lotion"), ("тоник", "toner"), ("эссенци", "essence"), ("маск", "mask"), ("концентрат", "serum"), ("масл", "oil"),
    ("эликсир", "elixir"), ("патч", "patch"), ("флюид", "fluid"), ("база", "foundation_base"), ("гел", "gel"), ("пен", "foam"),
    ("мыл", "soap"), ("молочк", "milk"), ("мицелл", "micellar"), ("скраб", "scrub"), ("пилинг", "peeling"), ("гомм", "gommage"),
    ("шампунь", "shampoo"), ("кондиционер", "conditioner"), ("бальзам-конд", "conditioner"), ("спре", "spray"), ("дымк", "spray"),
    ("мист", "spray"), ("сыворотка-сп", "spray"), ("помад", "lipstick"), ("блеск", "lipgloss"), ("карандаш", "pencil"),
    ("подводк", "liner"), ("консил", "concealer"), ("палетк", "palette"), ("тен", "palette"), ("кисть", "brush_tool"),
    ("очист", "cleanser"), ("тональн", "foundation"), ("основ", "foundation"), ("пудр", "powder"), ("румян", "blush"),
    ("хаила", "highlighter"), ("хайла", "highlighter"), ("бронз", "bronzer"), ("праймер", "primer"), ("лаин", "liner"),
    ("дезодорант", "deodorant"), ("антиперспир", "deodorant"), ("свеч", "candle"), ("атомаизер", "atomizer"), ("футляр", "case"),
    ("массаж", "device"), ("бальзам", "balm"), ("набор", "set"), ("рефил", "refill"), ("рефилл", "refill"),
]

# Stems that make a set, and the stem of a leading refill word.
SET_STEMS = ["набор", "сет"]
REFILL_STEM = "рефил"

# Kinds of palettes, concentrations of perfumes and body parts, in scanning order.
PALETTE_STEMS = [("коррекц", "corrector"), ("тен", "eyeshadow"), ("хаила", "highlighter"), ("хайла", "highlighter"), ("румян", "blush"), ("брон", "bronzer")]
PERFUME_STEMS = [("духи", "parfum"), ("парфюмерн", "edp"), ("туалетн", "edt"), ("одеколон", "cologne")]
BODY_STEMS = [
    ("глаз", "eye"), ("век", "eye"), ("ресниц", "lashes"), ("брове", "brows"), ("губ", "lips"), ("лиц", "face"),
    ("ног", "feet"), ("рук", "hands"), ("шеи", "neck"), ("декольте", "decolletage"), ("тел", "body"),
]

# Buckets that split by body part, and those that are for the face where none is named.
BODY_BUCKETS = [
    "cream", "serum", "oil", "lotion", "gel", "balm", "fluid", "mask", "essence", "elixir", "milk", "foam", "soap", "scrub", "patch",
    "toner", "cleanser", "spray", "mist", "foundation_base",
]
FACE_BUCKETS = ["cream", "serum", "essence", "toner", "foundation_base"]

# Words that don't tell products apart, and words that mark a variant.
STOPWORDS = [
    "cream", "creme", "serum", "lotion", "toner", "cleanser", "wash", "gel", "milk", "foam", "mask", "oil", "water", "balm", "butter",
    "lipstick", "gloss", "lipglass", "liner", "pencil", "mascara", "foundation", "blush", "bronzer", "highlighter", "powder", "primer",
    "base", "concealer", "makeup", "treatment", "shampoo", "conditioner", "spray", "mist", "perfume", "parfum", "eau", "cologne",
    "fragrance", "deodorant", "antiperspirant", "moisturizer", "moisturizing", "moisturising", "set", "kit", "collection", "duo", "trio",
    "combo", "edition", "edp", "edt", "mini", "travel", "spf", "men", "women", "homme", "femme", "pour", "jour", "nuit", "the", "with",
    "and", "for",
]
VARIANT_MARKERS = [
    "extreme", "intense", "intensely", "original", "classic", "signature", "oud", "fraiche", "sport", "drama", "prestige", "limited",
    "refill", "concentrate", "essence", "elixir",
]

# Spellings of units.
UNITS = {
    "мл": "ml", "милилитр": "ml", "миллилитр": "ml", "г": "g", "гр": "g", "грамм": "g", "л": "l", "литр": "l", "шт": "pcs", "штук": "pcs",
    "унц": "oz", "унция": "oz", "унций": "oz", "кг": "kg", "ml": "ml", "milliliter": "ml", "milliliters": "ml", "g": "g", "gram": "g",
    "grams": "g", "oz": "oz", "ounce": "oz", "ounces": "oz", "fl": "fl", "kg": "kg", "l": "l", "liter": "l", "liters": "l", "pcs": "pcs", "pc": "pcs",
}

# Volume patterns over lower-cased text: a set of N of an amount, N times an amount, an amount; and patterns of multipacks.
AMOUNT = r"([0-9]+(?:[.,][0-9]+)?)\s*([a-zа-яё]+)"
SET_OF_VOLUME = r"set\s+of\s+([0-9]+)\s*[xх×]?\s*" + AMOUNT
TIMES_VOLUME = r"([0-9]+)\s*(?:[a-zа-яё]+)?\s*[xх×]\s*" + AMOUNT
MULTIPACK = [r"\bset\s+of\s+[0-9]+", r"\bnabor\b|\bнабор", r"\bkit\b", r"\bкомплект", r"[0-9]+\s*шт\b", r"[0-9]+\s*[xх×]\s*[0-9]+"]

# Latin spellings of Cyrillic letters, Kazakh ones included.
LATIN_OF = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ё": "e", "ж": "zh", "з": "z", "и": "i", "й": "y", "к": "k", "л": "l",
    "м": "m", "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f", "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh",
    "щ": "shch", "ъ": "", "ы": "y", "ь": "", "э": "e", "ю": "yu", "я": "ya", "ә": "a", "ғ": "g", "қ": "q", "ң": "n", "ө": "o", "ұ": "u",
    "ү": "u", "һ": "h", "і": "i",
}
SLUG_LETTERS = "a-z0-9а-яёәғқңөұүһі"
CYRILLIC = "а-яёәғқңөұүһі"

# Endings that one catalogue adds to brand names, and names of size attributes.
BRAND_ENDINGS = ["beauty", "perfume", "parfums", "london", "paris", "cosmetics"]
SIZE_NAMES = ["размер", "объем", "объём"]

# The sane price range, and the page size below which a page isn't a product page.
PRICE_MIN, PRICE_MAX = 100, 1_000_000
SHELL_CHARS = 30_000
GATE_TITLE = "checking"

# What product pages mark their prices, headings and volumes with.
PRICE_SPEC = "priceSpecification"
NO_SALE_KINDS = ["StrikethroughPrice", "ListPrice"]
WAS_KIND = "StrikethroughPrice"
MEMBERS_PHRASE = "при авторизации"
HEADING_CLASS, BRAND_CLASS, NAME_CLASS = "_ga-pdp-title__heading_", "_ga-pdp-title__brand_", "_ga-pdp-title__name_"
VOLUME_WORD = "объём"
TEXT_TAGS = ["span", "div", "p", "label", "small", "h1", "h2", "h3", "h4", "h5", "h6"]
VOID_TAGS = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"]
