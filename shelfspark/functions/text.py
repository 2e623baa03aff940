"""Names, brands and slugs."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfspark.functions.vocabulary import BRAND_ENDINGS, CYRILLIC, LATIN_OF, SLUG_LETTERS


def _plain(char: str) -> str:
    return "".join(x for x in unicodedata.normalize("NFKD", char) if not unicodedata.combining(x))


#: Planes that hold letters with a decomposition, and the Hangul syllables, whose decomposition is arithmetic.
_LAST = 0x30000
HANGUL, HANGUL_END = 0xAC00, 0xD7A4
VOWELS, FINALS = 21, 28


@cache
def _folds() -> tuple[str, str, dict[str, str]]:
    """Letters whose compatibility decomposition without marks is one character, then those without any; their targets; and the
    letters with a longer one (ligatures, fractions, digraphs, units). Hangul syllables are left to arithmetic."""
    single, gone, several = [], [], {}
    for code in range(0x80, _LAST):
        if 0xD800 <= code < 0xE000 or HANGUL <= code < HANGUL_END:
            continue
        char = chr(code)
        plain = _plain(char)
        if plain == "":
            gone.append(char)
        elif len(plain) == 1 and plain != char:
            single.append((char, plain))
        elif len(plain) > 1:
            several[char] = plain
    return "".join(a for a, _ in single) + "".join(gone), "".join(b for _, b in single), several


def once(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value), with the value computed once however often f names it; in branches it would be computed again at each place."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def is_ascii(c: Column) -> Column:
    return F.octet_length(c) == F.char_length(c)


def _syllable(x: Column) -> Column:
    """A Hangul syllable as its two or three letters: their numbers are the digits of the syllable's place."""
    letters = lambda first, n: F.split(F.lit(" ".join(chr(first + k) for k in range(n))), " ")
    place = F.ascii(x) - HANGUL
    last = (place % FINALS).cast("int")
    final = F.when(last > 0, F.get(letters(0x11A8, FINALS - 1), last - 1)).otherwise("")
    return F.concat(F.get(letters(0x1100, 19), F.floor(place / (VOWELS * FINALS)).cast("int")), F.get(letters(0x1161, VOWELS), (F.floor(place / FINALS) % VOWELS).cast("int")), final)


def fold(c: Column) -> Column:
    """Letters without their marks (compatibility decomposition), for every code point as the standard library has it. ASCII text is left
    alone, and single letters are looked up only where one decomposes to several."""
    return once(c, _folded)


def _folded(c: Column) -> Column:
    before, after, several = _folds()
    short = F.translate(c, before, after)
    # one literal, which the optimiser turns into the map; private-use characters part its entries
    table = F.str_to_map(F.lit("\ue000".join(f"{a}\ue001{b}" for a, b in several.items())), F.lit("\ue000"), F.lit("\ue001"))
    of = lambda x: F.when(x.between(chr(HANGUL), chr(HANGUL_END - 1)), _syllable(x)).otherwise(F.coalesce(F.try_element_at(table, x), x))
    # ASCII stretches stay whole, other text goes by code points, not halves of them
    pieces = F.regexp_extract_all(short, F.lit(r"(?s)[\x00-\x7F]+|."), 0)
    long = F.array_join(F.transform(pieces, lambda x: F.when(is_ascii(x), x).otherwise(of(x))), "")
    expands = (F.char_length(F.translate(c, "".join(several), "")) < F.char_length(c)) | c.rlike(f"[{chr(HANGUL)}-{chr(HANGUL_END - 1)}]")
    return F.when(is_ascii(c), c).when(expands, long).otherwise(short)


def _name_of(low: Column, folded: Column) -> Column:
    plain = F.when(is_ascii(low), F.regexp_replace(low, r"[^\w\s]+", " ")).otherwise(F.regexp_replace(folded, r"(?U)[^\w\s]+", " "))
    return once(plain, lambda x: F.trim(F.when(is_ascii(x), F.regexp_replace(x, r"\s+", " ")).otherwise(F.regexp_replace(x, r"(?U)\s+", " "))))


def _slug_of(folded: Column) -> Column:
    plain = F.regexp_replace(folded, "['’ʼʹ]", "")
    return F.regexp_replace(F.regexp_replace(plain, f"[^{SLUG_LETTERS}]+", "-"), "^-+|-+$", "")


def normalise_name(c: Column) -> Column:
    """Lower case, without marks, punctuation as single blanks; null is empty."""
    return once(F.lower(F.coalesce(c, F.lit(""))), lambda low: _name_of(low, _folded(low)))


def slugify(c: Column) -> Column:
    """Lower case, without marks and apostrophes, everything but letters and digits as single hyphens."""
    return _slug_of(fold(F.lower(c)))


def name_and_slug(c: Column) -> Column:
    """struct(name, slug) of a text, as normalise_name and slugify give them; it is folded once."""
    low = F.lower(F.coalesce(c, F.lit("")))
    both = once(low, lambda x: F.struct(c.isNull().alias("missing"), x.alias("low"), _folded(x).alias("folded")))
    slug = lambda x: F.when(~x["missing"], _slug_of(x["folded"]))
    return once(both, lambda x: F.struct(_name_of(x["low"], x["folded"]).alias("name"), slug(x).alias("slug")))


def transliterate(c: Column) -> Column:
    """Lower-cased Cyrillic as Latin letters."""
    out = F.lower(c)
    for letter, latin in LATIN_OF.items():
        if len(latin) > 1:
            out = F.replace(out, F.lit(letter), F.lit(latin))
    one = [x for x, y in LATIN_OF.items() if len(y) == 1]
    none = [x for x, y in LATIN_OF.items() if not y]
    return F.translate(out, "".join(one + none), "".join(LATIN_OF[x] for x in one))


def bilingual_slugs(c: Column) -> Column:
    """[Latin slug, Cyrillic slug where there is one], without empty ones."""
    own = slugify(c)
    cyrillic = F.when(own.rlike(f"[{CYRILLIC}]"), own)
    return F.filter(F.array(slugify(transliterate(c)), cyrillic), lambda x: x.isNotNull() & (x != ""))


def brand_slug(c: Column) -> Column:
    """A brand's slug before aliases are looked up (`sources.adapter.normalise` does so); null is empty."""
    return slugify(F.coalesce(c, F.lit("")))


def kebab(c: Column) -> Column:
    """The default path name of a brand: blanks and underscores as hyphens."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[_\s]+", "-"), "^-+|-+$", "")


def brand_key(c: Column) -> Column:
    """An aggressive key: endings like -beauty or _paris dropped, as often as they come, then all separators."""
    ends = "|".join(BRAND_ENDINGS)
    return F.regexp_replace(F.regexp_replace(F.trim(F.lower(c)), f"(?:[ _-]+(?:{ends}))+$", ""), "[\\s\\-_'’]+", "")
