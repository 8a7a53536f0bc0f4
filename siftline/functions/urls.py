"""URL expressions. A url that a function can't take gives null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftline.functions.text import bind, normalize_text, text_or_empty

# Tracking parameters.
TRACKING_KEYS = ("fbclid", "gclid", "mc_cid", "mc_eid", "ref", "source")
LEGACY_TRACKING_KEYS = ("fbclid", "gclid", "yclid", "msclkid", "ref")
LEGACY_TRACKING_PREFIXES = ("utm_", "mc_")
# Public suffixes of two labels.
MULTIPART_SUFFIXES = ("co.uk", "com.au", "com.br", "co.nz", "co.jp", "com.mx")
# What tells an article's url and title.
ARTICLE_HINTS = (
    "article", "news", "business", "real-estate", "commercial", "development", "construction", "project", "opening",
    "lease", "tenant", "acquisition", "property", "multifamily", "industrial", "retail", "office", "azre", "blog",
    "buildout", "groundbreaking", "permit", "permits", "redevelopment", "rezoning", "ribbon-cutting", "tenant-improvement",
)
LEGACY_ARTICLE_HINTS = ARTICLE_HINTS[:19]
EVENT_TERMS = (
    "acquired", "acquisition", "approved", "breaks ground", "completed", "construction", "expands", "expansion",
    "groundbreaking", "lease", "leased", "opens", "opening", "plans", "redevelopment", "relocates", "renovation",
    "rezoning", "ribbon cutting", "site acquired",
)
PROPERTY_TERMS = (
    "apartments", "campus", "center", "commercial", "community", "development", "facility", "hotel", "industrial",
    "medical office", "mixed use", "multifamily", "office", "project", "property", "restaurant", "retail", "self storage",
    "store", "warehouse",
)
PLACE_TERMS = (
    "arizona", "phoenix", "tucson", "mesa", "scottsdale", "tempe", "chandler", "gilbert", "glendale", "peoria",
    "surprise", "goodyear", "avondale", "flagstaff", "prescott", "yuma", "buckeye", "queen creek", "maricopa", "pinal",
    "casa grande", "lake havasu", "bullhead city", "apache junction", "oro valley", "sierra vista", "fountain hills",
    "cottonwood", "sedona", "nogales", "kingman", "marana", "sahuarita", "san tan valley",
)
REJECT_SEGMENTS = ("about", "advertise", "author", "authors", "careers", "category", "contact", "events", "login", "privacy", "search", "subscribe", "tag", "terms")
REJECT_EXTENSIONS = (
    ".css", ".csv", ".doc", ".docx", ".gif", ".ico", ".jpeg", ".jpg", ".js", ".json", ".mp3", ".mp4", ".pdf", ".png",
    ".rss", ".svg", ".webp", ".xml", ".zip",
)
_SPLIT = r"(?s)^([A-Za-z][A-Za-z0-9+.\-]*):(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def _raw(url: Column | str) -> Column:
    return F.regexp_replace(F.btrim(text_or_empty(url)), "[\\t\\r\\n]", "")


def part(url: Column | str, number: int) -> Column:
    return F.regexp_extract(_raw(url), _SPLIT, number)


def scheme(url: Column | str) -> Column:
    return F.lower(part(url, 1))


def _place(url: Column | str) -> Column:
    return F.regexp_replace(part(url, 2), r"^.*@", "")


def host(url: Column | str) -> Column:
    """The lower-cased host without user, port and brackets; '' if there is none."""
    bare = lambda place: F.when(F.startswith(place, F.lit("[")), F.regexp_extract(place, r"^\[([^\]]*)\]", 1)).otherwise(F.substring_index(place, ":", 1))
    return F.lower(bind(_place(url), bare))


def port_text(url: Column | str) -> Column:
    return F.regexp_extract(_place(url), r"^(?:\[[^\]]*\]|[^:]*):(.*)$", 1)


def path(url: Column | str) -> Column:
    return part(url, 3)


def _port(url: Column | str) -> Column:
    """The port, 0 if none is given, null if it isn't one."""
    number = lambda text: F.when(F.regexp_like(text, F.lit(r"^\d{1,9}$")), text.try_cast("int"))
    known = lambda text: bind(number(text), lambda n: F.when(text == "", F.lit(0)).when(n <= 65_535, n))
    return bind(port_text(url), known)


def _pairs(query: Column) -> Column:
    """The decoded (key, value) pairs of a query, blank values kept."""
    decoded = lambda c: F.coalesce(F.try_url_decode(F.regexp_replace(c, "%(?![0-9A-Fa-f]{2})", "%25")), c)
    items = F.filter(F.split(query, "&"), lambda x: x != "")
    return F.transform(items, lambda x: F.struct(decoded(F.substring_index(x, "=", 1)).alias("k"), decoded(F.when(F.contains(x, F.lit("=")), F.substring(x, F.instr(x, "=") + 1, F.length(x))).otherwise(F.lit(""))).alias("v")))


def _encoded(c: Column) -> Column:
    """Form encoding as urllib does it: '*' is escaped and '~' isn't."""
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def _query(url: Column | str, dropped) -> Column:
    kept = F.array_sort(F.filter(_pairs(part(url, 4)), lambda p: ~dropped(p["k"])))
    return F.array_join(F.transform(kept, lambda p: F.concat(_encoded(p["k"]), F.lit("="), _encoded(p["v"]))), "&")


def _with_query(base: Column, query: Column) -> Column:
    return F.when(query == "", base).otherwise(F.concat(base, F.lit("?"), query))


def canonicalize_url(url: Column | str) -> Column:
    """http(s) only; lower-cased host, no user, fragment, default port or tracking; sorted query; one slash a step.

    The url and its parts are bound, so an expression that is given, or a filter that is pushed below, stays small.
    """

    def whole(raw: Column, p: Column) -> Column:
        kind, number = p["kind"], p["number"]
        standard = ((kind == "http") & (number == 80)) | ((kind == "https") & (number == 443)) | (number == 0)
        place = F.when(standard, p["host"]).otherwise(F.concat_ws(":", p["host"], number))
        steps = bind(F.regexp_replace(F.coalesce(F.nullif(path(raw), F.lit("")), F.lit("/")), "/{2,}", "/"), lambda x: F.when(x == "/", x).otherwise(F.regexp_replace(x, "/+$", "")))
        query = _query(raw, lambda k: F.startswith(F.lower(k), F.lit("utm_")) | F.lower(k).isin(*TRACKING_KEYS))
        made = bind(query, lambda q: _with_query(F.concat(kind, F.lit("://"), place, steps), q))
        return F.when(kind.isin("http", "https") & (p["authority"] != "") & number.isNotNull(), made)

    parts = lambda raw: F.struct(scheme(raw).alias("kind"), _port(raw).alias("number"), host(raw).alias("host"), part(raw, 2).alias("authority"))
    return bind(text_or_empty(url), lambda raw: bind(parts(raw), lambda p: whole(raw, p)))


def canonicalize_url_legacy(url: Column | str) -> Column:
    """Any scheme but data and javascript; default ports, repeated slashes and keys' case stay as they are."""
    kind, number = scheme(url), _port(url)
    place = F.when(number == 0, host(url)).otherwise(F.concat_ws(":", host(url), number))
    steps = F.coalesce(F.nullif(F.regexp_replace(path(url), "/+$", ""), F.lit("")), F.lit("/"))
    dropped = lambda k: k.isin(*LEGACY_TRACKING_KEYS) | F.startswith(k, F.lit(LEGACY_TRACKING_PREFIXES[0])) | F.startswith(k, F.lit(LEGACY_TRACKING_PREFIXES[1]))
    slashes = F.when((part(url, 2) != "") | F.startswith(steps, F.lit("/")), F.lit("//")).otherwise(F.lit(""))
    whole = _with_query(F.concat(kind, F.lit(":"), slashes, place, steps), _query(url, dropped))
    return F.when((kind != "") & ~kind.isin("data", "javascript") & number.isNotNull(), whole)


def registrable_domain(url: Column | str) -> Column:
    """The last two labels of the host, or three where the two are a public suffix."""
    last = lambda labels, n: F.array_join(F.slice(labels, F.greatest(F.lit(1), F.size(labels) - n + 1), n), ".")
    domain = lambda labels: F.when((F.size(labels) > 2) & last(labels, 2).isin(*MULTIPART_SUFFIXES), last(labels, 3)).otherwise(last(labels, 2))
    return bind(F.split(F.btrim(host(url), F.lit(".")), r"\."), domain)


def same_domain(left: Column | str, right: Column | str) -> Column:
    return bind(registrable_domain(left), lambda a: (a != "") & (a == registrable_domain(right)))


def _site(url: Column | str) -> Column:
    return F.regexp_replace(host(url), r"^www\.", "")


def same_site(left: Column | str, right: Column | str) -> Column:
    """Equal hosts without www, or one a subdomain of the other."""
    within = lambda a, b: F.endswith(a, F.concat(F.lit("."), b))
    return bind(F.struct(_site(left).alias("a"), _site(right).alias("b")), lambda s: (s["a"] != "") & (s["b"] != "") & ((s["a"] == s["b"]) | within(s["a"], s["b"]) | within(s["b"], s["a"])))


def normalized_domain(value: Column | str) -> Column:
    """P10: the host of a url or bare domain; '' where there is none."""
    raw = F.lower(F.btrim(text_or_empty(value)))
    url = F.when(F.contains(raw, F.lit("://")), raw).otherwise(F.concat(F.lit("https://"), raw))
    return F.when((raw == "") | canonicalize_url(url).isNull(), F.lit("")).otherwise(host(url))


def normalize_linkedin(value: Column | str) -> Column:
    """A profile's url on one host; '' for anything else."""
    steps, where = F.regexp_replace(path(value), "/+$", ""), host(value)
    fits = scheme(value).isin("http", "https") & ((where == "linkedin.com") | F.endswith(where, F.lit(".linkedin.com"))) & F.startswith(steps, F.lit("/in/"))
    return F.when(fits, F.concat(F.lit("https://www.linkedin.com"), steps)).otherwise(F.lit(""))


def _date(year: Column, month: Column, day: Column) -> Column:
    return F.format_string("%s-%s-%s", F.lpad(year, 4, "0"), F.lpad(month, 2, "0"), F.lpad(day, 2, "0")).try_cast("date")


def date_from_url(url: Column | str) -> Column:
    """Three segments of digits that start with a year from 2000 to 2100, else 20yy-m-d within the path.

    Segments that look like a date but are none give null, without the second form being tried.
    """
    segments = r"(?:\A|/)0*(?:20[0-9]{2}|2100)/+[0-9]+/+[0-9]+(?=/|\z)"
    pattern = r"(?<![0-9])20[0-9]{2}[-_][0-9]{1,2}[-_][0-9]{1,2}(?![0-9])"
    tight = lambda c: F.regexp_replace(c, "^0+(?=.)", "")
    digits = lambda c: F.transform(F.regexp_extract_all(c, F.lit("[0-9]+"), F.lit(0)), tight)
    dated = lambda said: bind(digits(said), lambda d: F.when((F.length(F.get(d, F.lit(1))) <= 2) & (F.length(F.get(d, F.lit(2))) <= 2), _date(*[F.get(d, F.lit(i)) for i in range(3)])))
    found = lambda steps: bind(F.regexp_extract(steps, segments, 0), lambda said: F.when(said != "", said).otherwise(F.regexp_extract(steps, pattern, 0)))
    return bind(bind(path(url), found), lambda said: F.when(said != "", dated(said)))


def contains_any(text: Column, terms: tuple[str, ...]) -> Column:
    """Whether text holds one of the terms: one alternation, so the text is read once."""
    return F.regexp_like(text, F.lit("(?:" + "|".join(t.replace(".", r"\.") for t in terms) + ")"))


def contains_word(text: Column, terms: tuple[str, ...]) -> Column:
    return F.regexp_like(text, F.lit("(?<![a-z0-9])(?:" + "|".join(terms) + ")(?![a-z0-9])"))


def article_score(url: Column | str, title: Column | str, base_url: Column | str, legacy: bool = False) -> Column:
    """How likely a link leads to an article; 0 for roots, files and rejected sections."""
    trim = lambda c: F.coalesce(F.nullif(F.regexp_replace(path(c), "/+$", ""), F.lit("")), F.lit("/"))
    steps = F.lower(trim(url))
    segments = F.filter(F.split(steps, "/"), lambda s: s != "")
    slug_words = F.filter(F.split(F.coalesce(F.try_element_at(segments, F.lit(-1)), F.lit("")), r"[-_\s]+"), lambda w: w != "")
    points = lambda test, n: F.when(test, F.lit(n)).otherwise(F.lit(0))
    score = points(date_from_url(url).isNotNull(), 3) + points(contains_any(steps, LEGACY_ARTICLE_HINTS if legacy else ARTICLE_HINTS), 2)
    score = score + points((F.size(segments) > 0) & (F.size(slug_words) >= 4), 2) + points(F.length(F.btrim(text_or_empty(title))) >= 25, 1)
    if not legacy:
        said = normalize_text(title)
        score = score + points(contains_any(said, EVENT_TERMS) & contains_any(said, PROPERTY_TERMS), 2) + points(contains_word(said, PLACE_TERMS), 1)
    file = F.regexp_like(steps, F.lit("(?:" + "|".join(e.replace(".", r"\.") for e in REJECT_EXTENSIONS) + ")$"))
    none = (trim(url) == "/") | (trim(url) == trim(base_url)) | file | F.arrays_overlap(segments, F.array(*[F.lit(s) for s in REJECT_SEGMENTS]))
    return F.when(none, F.lit(0)).otherwise(score)


def outside_window(url: Column | str, since: str, until: str | None = None) -> Column:
    """whether a listing's own ?date=, ?year=&month= or /yyyy/mm lies outside the window."""
    pairs = F.transform(_pairs(part(url, 4)), lambda p: F.struct(F.lower(p["k"]).alias("k"), p["v"].alias("v")))
    last = lambda key: F.coalesce(F.try_element_at(F.transform(F.filter(pairs, lambda p: p["k"] == key), lambda p: p["v"]), F.lit(-1)), F.lit(""))
    exact_text = F.get(F.transform(F.filter(pairs, lambda p: (p["k"] == "date") & F.regexp_like(p["v"], F.lit(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"))), lambda p: p["v"]), F.lit(0))
    exact = exact_text.try_cast("date")
    low, high = F.lit(since).cast("date"), F.lit(until).cast("date")
    beyond = lambda d, a, b: (d < a) | F.coalesce(d > b, F.lit(False))
    month_number = lambda y, m: y.try_cast("int") * 12 + m.try_cast("int")
    bound = lambda d: F.year(d) * 12 + F.month(d)
    in_query = F.when(F.regexp_like(last("year"), F.lit("^20[0-9]{2}$")) & F.regexp_like(last("month"), F.lit("^(?:0?[1-9]|1[0-2])$")), month_number(last("year"), last("month")))
    pattern = "(?<![0-9])(20[0-9]{2})[-_/]?(0[1-9]|1[0-2])(?![0-9])"
    found = [F.regexp_extract(path(url), pattern, i) for i in (1, 2)]
    in_path = F.when(found[0] != "", month_number(*found))
    month = F.coalesce(in_query, in_path)
    return F.when(exact.isNotNull(), beyond(exact, low, high)).when(month.isNotNull(), beyond(month, bound(low), bound(high))).otherwise(F.lit(False))
