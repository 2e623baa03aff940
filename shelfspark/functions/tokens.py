"""Product types and the tokens by which names are compared. All are native expressions, computed once for each product, never for each pair."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfspark.functions.vocabulary import BODY_BUCKETS, BODY_STEMS, FACE_BUCKETS, PALETTE_STEMS, PERFUME_STEMS, PRODUCT_STEMS, REFILL_STEM, SET_STEMS, STOPWORDS, VARIANT_MARKERS


def latin_tokens(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit("[a-z0-9]{3,}"), 0))


def url_tokens(url: Column, host: str = r"[^/]+") -> Column:
    """Tokens of the slug in .../123-some-slug."""
    slug = F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), rf"://{host}/[0-9]+-([a-z0-9\-]+)", 1)
    return F.array_distinct(F.filter(F.split(slug, "-"), lambda x: (F.length(x) >= 3) & x.rlike("^[a-z0-9]+$")))


def brand_tokens(c: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), r"[-_\s]+"), lambda x: F.length(x) >= 3))


def telling_tokens(tokens: Column, brand: Column) -> Column:
    """Tokens without stopwords, the brand's own and numbers."""
    rest = F.array_except(F.array_except(tokens, F.split(F.lit(" ".join(STOPWORDS)), " ")), brand_tokens(brand))
    return F.filter(rest, lambda x: ~x.rlike("^[0-9]+$"))


def cyrillic_words(c: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), r"(?U)\s+"), lambda x: x.rlike("^[а-яё-]{3,}$"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _ordered_pairs(words: Column) -> Column:
    return F.flatten(F.transform(words, lambda x: F.transform(F.filter(words, lambda y: y != x), lambda y: F.concat(x, F.lit("-"), y))))


def _first(words: Column, stems: list[tuple[str, str]]) -> Column:
    """What the first word with a stem has, of its first stem in the list's order; null if none has one."""
    # two constant arrays keep the plan small, where a CASE would have a branch for each stem
    stem, name = (F.split(F.lit(" ".join(x)), " ") for x in zip(*stems, strict=True))
    place = F.transform(words, lambda w: F.array_position(F.transform(stem, lambda x: w.startswith(x)), F.lit(True)))
    return F.get(name, F.try_element_at(F.filter(place, lambda k: k > 0), F.lit(1)).cast("int") - 1)


def product_type(c: Column) -> Column:
    """The product type of a name, refined by palette kind, perfume concentration or body part; null if no word tells.

    Only the first three Cyrillic words name the type: a set word anywhere among them wins, leading refill words are dropped, and
    ordered pairs of words go before single ones.
    """

    def refine(base: Column, every: Column) -> Column:
        part = F.coalesce(_first(every, BODY_STEMS), F.when(base.isin(FACE_BUCKETS), F.lit("face")))
        return (
            F.when(base == "palette", F.concat_ws("_", base, _first(every, PALETTE_STEMS)))
            .when(base == "perfume", F.concat_ws("_", base, _first(every, PERFUME_STEMS)))
            .when(base.isin(BODY_BUCKETS), F.concat_ws("_", base, part))
            .otherwise(base)
        )

    def scan(every: Column, leading: Column) -> Column:
        is_set = F.exists(leading, lambda x: x.startswith(SET_STEMS[0]) | x.startswith(SET_STEMS[1]))
        # of three words, refill words in front go: as many as there are before the first other word
        first, second, third = (F.coalesce(F.try_element_at(leading, F.lit(k)), F.lit("")).startswith(REFILL_STEM) for k in (1, 2, 3))
        skipped = F.when(~first, 0).when(~second, 1).when(~third, 2).otherwise(3)
        return let(F.slice(leading, skipped + 1, 3), lambda words: F.when(is_set, F.lit("set")).otherwise(let(_first(F.concat(_ordered_pairs(words), words), PRODUCT_STEMS), lambda base: refine(base, every))))

    return let(cyrillic_words(c), lambda every: let(F.slice(every, 1, 3), lambda leading: scan(every, leading)))


def has_variant(tokens: Column) -> Column:
    return F.arrays_overlap(tokens, F.array(*map(F.lit, VARIANT_MARKERS)))


def names_match(base: dict[str, Column], competitor: dict[str, Column]) -> Column:
    """Do two products with these features (name, type, tokens, telling) have the same name?

    Types that differ veto. Without any token on either side the names must be equal. Else tokens must overlap, and either the
    competitor's are all among the base's, or telling tokens overlap, no variant marker is on one side only, and not both sides
    have telling tokens of their own.
    """
    veto = F.coalesce(base["type"] != competitor["type"], F.lit(False))
    bare = (F.size(base["tokens"]) == 0) & (F.size(competitor["tokens"]) == 0)
    same = F.coalesce(base["name"], F.lit("")) == F.coalesce(competitor["name"], F.lit(""))
    within = F.size(F.array_except(competitor["tokens"], base["tokens"])) == 0
    only_base = F.array_except(base["telling"], competitor["telling"])
    only_other = F.array_except(competitor["telling"], base["telling"])
    told = (
        F.arrays_overlap(base["telling"], competitor["telling"])
        & ~(has_variant(only_base) | has_variant(only_other))
        & ((F.size(only_base) == 0) | (F.size(only_other) == 0))
    )
    return ~veto & F.when(bare, same).otherwise(F.arrays_overlap(base["tokens"], competitor["tokens"]) & (within | told))
