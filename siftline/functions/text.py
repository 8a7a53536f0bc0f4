"""Text expressions: normal forms, tokens, names. All are built-in column functions; null is treated as empty."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Business suffixes that an organization's key drops.
BUSINESS_SUFFIXES = (
    "llc", "l.l.c.", "l l c", "inc", "inc.", "incorporated", "corp", "corp.", "corporation",
    "ltd", "ltd.", "limited", "lp", "l.p.", "llp", "l.l.p.", "company", "co", "co.",
)
# Words that carry no identity of an event in a headline.
NOISE_WORDS = (
    "square", "feet", "foot", "sqft", "million", "billion", "units", "unit", "acre", "acres", "story", "stories",
    "from", "with", "into", "near", "that", "this", "they", "their", "will", "have", "more", "than", "tops", "for",
    "the", "and", "new",
)
# Places too broad to name as a locality.
BROAD_PLACES = ("arizona", "arizona cities", "east valley", "maricopa county", "metro phoenix", "phoenix metro", "pinal county", "west valley")
KNOWN_PLACES = {"phoenix deer valley": "deer valley"}
# Abbreviations with a full stop, and what may stand before a name.
ABBREVIATIONS = ("inc", "corp", "co", "ltd", "llc", "l.l.c", "u.s", "u.s.a")
HONORIFICS = ("dr", "mr", "mrs", "ms", "miss", "prof")


def text_or_empty(c: Column | str) -> Column:
    return F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))


# The lower-case letters whose full case folding has an a to z that the letter itself hasn't.
FOLDS = {
    "ß": "ss", "ŉ": "ʼn", "ſ": "s", "ǰ": "j\u030c", "ẖ": "h\u0331", "ẗ": "t\u0308", "ẘ": "w\u030a", "ẙ": "y\u030a", "ẚ": "aʾ",
    "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st",
}


def casefold(c: Column) -> Column:
    """Case-folded as far as a to z go: lower case, and the few letters that fold to others. Texts without any cost one test."""
    low = F.lower(c)
    folded = low
    for letter, others in FOLDS.items():
        folded = F.replace(folded, F.lit(letter), F.lit(others))
    return F.when(F.regexp_like(low, F.lit(f"[{''.join(FOLDS)}]")), folded).otherwise(low)


def normalize_text(c: Column | str) -> Column:
    """Case-folded, everything but a-z and 0-9 collapsed to single spaces, trimmed."""
    return F.trim(F.regexp_replace(casefold(text_or_empty(c)), "[^a-z0-9]+", " "))


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def org_name_key(c: Column | str) -> Column:
    """Punctuation to spaces, then business suffixes out. The order matters: L.L.C. is by then l l c."""
    plain = squeeze(F.regexp_replace(F.lower(text_or_empty(c)), "[^a-z0-9 ]+", " "))
    words = [s for s in BUSINESS_SUFFIXES if "." not in s]
    return squeeze(F.regexp_replace(plain, r"\b(" + "|".join(words) + r")\b", " "))


def title_tokens(c: Column | str) -> Column:
    """The distinct significant words of a headline, sorted."""
    words = F.regexp_extract_all(F.lower(text_or_empty(c)), F.lit(r"([a-z][a-z\-]+)"), 1)
    keep = F.filter(words, lambda w: (F.length(w) >= 3) & ~w.isin(*NOISE_WORDS))
    return F.array_sort(F.array_distinct(keep))


def contact_name_key(c: Column | str) -> Column:
    """What stands before the first ' | ', lower-cased, spaces collapsed."""
    return F.lower(squeeze(F.substring_index(text_or_empty(c), " | ", 1)))


def slug(c: Column | str) -> Column:
    """Lower-cased, other characters to single hyphens."""
    return F.regexp_replace(F.regexp_replace(F.lower(text_or_empty(c)), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def feedback_key(c: Column | str) -> Column:
    """The first eight hex digits of SHA-1."""
    return F.left(F.sha1(F.encode(text_or_empty(c), "utf-8")), F.lit(8))


def words(c: Column) -> Column:
    return F.filter(F.split(c, r"\s+"), lambda w: w != "")


def word_count(c: Column | str) -> Column:
    return F.size(words(text_or_empty(c)))


def clean_slot(c: Column | str, lowercase: bool = True) -> Column:
    """Spaces collapsed, punctuation off both ends."""
    out = F.btrim(squeeze(text_or_empty(c)), F.lit(" ,.;:!?"))
    return F.lower(out) if lowercase else out


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value's expression in the plan once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def html_title(c: Column | str) -> Column:
    """What a page's title element holds, tags out and spaces collapsed."""
    return squeeze(F.regexp_replace(F.regexp_extract(text_or_empty(c), r"(?is)<title[^>]*>(.*?)</title>", 1), "(?s)<[^>]+>", " "))


def first_name(c: Column | str) -> Column:
    """The first word that isn't an honorific."""
    kept = F.regexp_replace(F.trim(text_or_empty(c)), r"(?i)^(?:(?:" + "|".join(HONORIFICS) + r")\.*(?:\s+|$))+", "")
    return F.btrim(F.coalesce(F.get(words(kept), F.lit(0)), F.lit("")), F.lit(" ,"))


def personalize(text: Column | str, name: Column | str) -> Column:
    """The greeting's placeholder replaced by the name; null where either is missing or the placeholder stays."""
    text, name = text_or_empty(text), text_or_empty(name)
    mark = "Hi [first name]"
    out = F.concat(F.lit("Hi "), name, F.substring(text, F.lit(len(mark) + 1), F.length(text)))
    return F.when((name != "") & F.startswith(text, F.lit(mark)) & ~F.contains(out, F.lit("[first name]")), out)


def locality(c: Column | str) -> Column:
    """One place of at most three words; broad places, counties and groups of cities give ''.

    The place is what stands before the first comma and the first word that joins it to another, without the words that
    only say that it is a place.
    """
    known = F.create_map(*[F.lit(x) for item in KNOWN_PLACES.items() for x in item])
    last = lambda said: F.try_element_at(said, F.lit(-1))

    def without(said: Column, *trailing: str) -> Column:
        return bind(said, lambda w: F.slice(w, F.lit(1), F.size(w) - F.when((F.size(w) > 1) & last(w).isin(*trailing), 1).otherwise(0)))

    def first(said: Column) -> Column:
        joins = F.filter(F.transform(said, lambda w, i: F.when(w.isin("and", "/", "near") & (i > 0), i)), lambda i: i.isNotNull())
        return F.slice(said, F.lit(1), F.coalesce(F.get(joins, F.lit(0)), F.size(said)))

    def named(said: Column) -> Column:
        name = F.array_join(said, " ")
        broad = name.isin(*BROAD_PLACES) | (F.size(said) > 3) | ((F.size(said) > 1) & last(said).isin("county", "cities"))
        return F.when(F.coalesce(broad, F.lit(False)), F.lit("")).otherwise(F.coalesce(known[name], name))

    kept = bind(words(F.substring_index(clean_slot(c), ",", 1)), first)
    return bind(without(without(kept, "az", "arizona"), "area", "region", "outskirts"), named)


def sentence_count(c: Column | str) -> Column:
    """Words that end a sentence: by a full stop, question or exclamation mark, last or before a capital.

    An abbreviation or an initial before a capital ends none, nor does a point inside a number.
    """
    starts = lambda w: F.regexp_like(w, F.lit("^[A-Z]"))
    short = lambda w: F.ltrim(F.lower(w), F.lit("([\"'")).isin(*[f"{a}." for a in ABBREVIATIONS]) | F.regexp_like(w, F.lit(r"^[^A-Za-z0-9]*[A-Z]\.$"))

    def ends(said: Column) -> Column:
        last = lambda i: i == F.size(said) - 1
        return F.size(F.filter(said, lambda w, i: F.right(w, F.lit(1)).isin(".", "!", "?") & (last(i) | (starts(F.get(said, i + 1)) & ~short(w)))))

    return bind(words(text_or_empty(c)), ends)


def unescaped(c: Column) -> Column:
    """The common entities resolved, once."""
    for entity, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&")):
        c = F.replace(c, F.lit(entity), F.lit(sign))
    return c


def html_text(c: Column | str, limit: int | None = None) -> Column:
    """A page's text: scripts and styles out, tags to spaces, the common entities resolved, spaces collapsed."""
    out = F.regexp_replace(text_or_empty(c), r"(?is)<(script|style|noscript)\b.*?</\1\s*>", " ")
    out = squeeze(unescaped(F.regexp_replace(out, "(?s)<[^>]+>", " ")))
    return F.substring(out, 1, limit) if limit else out


def json_object(c: Column | str) -> Column:
    """The outermost braces of an answer, citation marks out; null where there are none."""
    return F.nullif(F.regexp_extract(F.regexp_replace(text_or_empty(c), "<<ccr:[^>]+>>", ""), r"(?s)(\{.*\})", 1), F.lit(""))


# Elements that never hold an article, and those that begin or end a block.
NO_ARTICLE = ("script", "style", "noscript", "template", "head", "nav", "header", "footer", "aside", "form")
BLOCKS = ("address", "article", "blockquote", "body", "br", "dd", "div", "dl", "dt", "figcaption", "figure", "h[1-6]", "hr", "html", "li", "main", "ol", "p", "pre", "section", "table", "tbody", "td", "th", "thead", "tr", "ul")
# Words of a class or id that mark a plain block as something beside the article.
BESIDE = ("ad", "ads", "advert", "advertisement", "breadcrumb", "comments", "cookie", "menu", "promo", "related", "share", "sidebar", "social", "sponsored")
#: What a block costs, in characters: shorter ones lower the sum, so a menu or a notice at the edge of an article stays out.
BLOCK_COST = 25


def main_text(c: Column | str, least: int = 200, most: int = 8000) -> Column:
    """P20: a page's article: the run of blocks with the largest sum of their weights, null below ``least`` characters.

    A block is what stands between tags that break a line. It weighs its characters, less twice those in links, less a cost; so text
    adds, and links and short bits take away. Of runs with one sum the one that ends first counts, and its
    longest. Blocks without text count nothing. The run is found in one pass: its sum ends where it would fall below zero.
    """
    beside = [rf"<{t}\b[^>]*\b(?:class|id)\s*=\s*[\"']?[^\"'>]*\b(?:{'|'.join(BESIDE)})\b[^>]*>.*?</{t}\s*>" for t in ("div", "section", "p", "ul", "span")]
    out = F.regexp_replace(text_or_empty(c), "(?is)<!--.*?-->|" + "|".join([*(rf"<{t}\b.*?</{t}\s*>" for t in NO_ARTICLE), *beside]), " ")
    plain = lambda x: squeeze(unescaped(F.regexp_replace(x, "(?s)<[^>]+>", " ")))
    linked = lambda x: F.aggregate(F.regexp_extract_all(x, F.lit(r"(?is)<a\b[^>]*>(.*?)</a\s*>"), 1), F.lit(0), lambda n, a: n + F.length(plain(a)))
    parts = F.transform(F.split(out, rf"(?i)</?(?:{'|'.join(BLOCKS)})\b[^>]*>"), lambda b: F.struct(plain(b).alias("said"), linked(b).alias("linked")))

    def best(blocks: Column) -> Column:
        weights = F.transform(blocks, lambda b, i: F.struct((F.length(b["said"]) - 2 * b["linked"] - BLOCK_COST).alias("w"), i.alias("i")))
        zero = F.struct(*[F.lit(0).alias(n) for n in ("sum", "first", "top", "from_", "to")])

        def step(a: Column, x: Column) -> Column:
            goes_on = a["sum"] >= 0
            total, first = F.when(goes_on, a["sum"] + x["w"]).otherwise(x["w"]), F.when(goes_on, a["first"]).otherwise(x["i"])
            better = total > a["top"]
            return F.struct(total.alias("sum"), first.alias("first"), F.when(better, total).otherwise(a["top"]).alias("top"), F.when(better, first).otherwise(a["from_"]).alias("from_"), F.when(better, x["i"] + 1).otherwise(a["to"]).alias("to"))

        run = lambda r: F.array_join(F.transform(F.slice(blocks, r["from_"] + 1, r["to"] - r["from_"]), lambda b: b["said"]), " ")
        return bind(F.aggregate(weights, zero, step), run)

    said = bind(F.filter(parts, lambda b: b["said"] != ""), best)
    return bind(said, lambda t: F.when(F.length(t) >= least, F.substring(t, 1, most)))
