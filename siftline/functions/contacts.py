"""Contact expressions: phones, mailboxes, packed strings, roles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftline.functions.text import normalize_text, squeeze, text_or_empty

# Mailbox hosts for throw-away addresses, and local parts that are no person's.
DISPOSABLE_DOMAINS = ("10minutemail.com", "discard.email", "guerrillamail.com", "mailinator.com", "sharklasers.com", "tempmail.com", "yopmail.com")
GENERIC_LOCALS = ("admin", "careers", "contact", "hello", "help", "info", "leasing", "marketing", "office", "press", "sales", "support")
LIST_GENERIC_LOCALS = (
    "info", "contact", "office", "hello", "admin", "support", "sales", "marketing", "general", "inquiries", "team",
    "service", "customerservice", "help", "noreply", "no-reply",
)
# Names that are a role or a team.
GENERIC_TITLES = (
    "property manager", "leasing agent", "leasing manager", "general manager", "facilities manager", "the property manager",
    "the leasing agent", "site manager", "operations team", "asset manager", "property management",
)
GENERIC_LAST_WORDS = ("management", "team", "group", "services", "department", "office", "company", "corporation", "llc", "inc")
# What tells a seniority, in the order in which it is asked.
SENIORITY = (
    ("owner", ("owner", "founder", "principal")),
    ("c_suite", ("chief ", "chairman", " coo", " ceo", " cfo", " cmo", " cto", "coo,", "ceo,", "cfo,", "cmo,", "cto,", " coo)", " ceo)", " cfo)", " cmo)", " cto)")),
    ("vp", ("vp ", "vice president", "vp,")),
    ("director", ("director",)),
    ("manager", ("manager",)),
)
SENIORITY_WEIGHT = {"owner": 5, "c_suite": 4, "vp": 3, "director": 2, "manager": 1}
# A role's score and rationale, in the order in which it is asked.
ROLES = (
    (100, "facilities_or_property_management", "facilit|property management"),
    (90, "operations_or_site_management", "operations|real property|branch manager|general manager|site manager|regional manager"),
    (70, "company_leadership", "owner|partner|president|chief executive|ceo|chief operating|coo|managing member"),
    (70, "real_estate_or_leasing", "real estate|leasing"),
    (50, "development_or_acquisition", "development|acquisition"),
)
LOCAL_SCOPES = "arizona|phoenix|local|regional"
_LABEL = "[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?"
EMAIL = rf"^[A-Za-z0-9.!#$%&'*+/=?^_`{{|}}~-]+@{_LABEL}(?:\.{_LABEL})+$"


def normalize_email(c: Column | str) -> Column:
    """P46"""
    return F.lower(F.btrim(text_or_empty(c)))


def normalize_phone(c: Column | str) -> Column:
    """Ten digits get +1, eleven to fifteen get +, all else is ''."""
    digits = F.regexp_replace(text_or_empty(c), "[^0-9]", "")
    return F.when(F.length(digits) == 10, F.concat(F.lit("+1"), digits)).when(F.length(digits).between(11, 15), F.concat(F.lit("+"), digits)).otherwise(F.lit(""))


def phone_key(c: Column | str) -> Column:
    """The last ten digits."""
    return F.right(F.regexp_replace(text_or_empty(c), "[^0-9]", ""), F.lit(10))


def email_domain(c: Column | str) -> Column:
    return F.lower(F.substring_index(text_or_empty(c), "@", -1))


def email_rejection(c: Column | str, domains: Column | None = None) -> Column:
    """the first reason against a mailbox, or ''. domains: an array of the organization's own domains."""
    mail, domain = text_or_empty(c), email_domain(c)
    local = F.regexp_replace(F.lower(F.substring_index(F.substring_index(mail, "@", 1), "+", 1)), "[^a-z0-9]", "")
    out = F.when(~F.regexp_like(mail, F.lit(EMAIL)), "email_syntax_invalid").when(domain.isin(*DISPOSABLE_DOMAINS), "email_domain_disposable").when(local.isin(*GENERIC_LOCALS), "email_generic_role_mailbox")
    if domains is not None:
        known = F.filter(F.transform(F.coalesce(domains, F.array().cast("array<string>")), lambda d: F.regexp_replace(F.lower(text_or_empty(d)), r"^www\.", "")), lambda d: d != "")
        own = F.exists(known, lambda d: (domain == d) | F.endswith(domain, F.concat(F.lit("."), d)))
        out = out.when((F.size(known) > 0) & ~own, "email_domain_organization_mismatch")
    return out.otherwise("")


def verify(email: Column | str, phone: Column, linkedin: Column, domains: Column, mx: Column, external: Column) -> Column:
    """a struct of status and reason. phone and linkedin are (raw, normalized) structs; mx and external are null if unknown."""
    mail, raw = normalize_email(email), text_or_empty(email)
    reason = email_rejection(mail, domains)
    decide = lambda status, why: F.struct(F.lit(status).alias("status"), (F.lit(why) if isinstance(why, str) else why).alias("reason"))
    by_mail = F.when(reason != "", decide("rejected", reason)).when(mx == F.lit(False), decide("rejected", "email_domain_has_no_mx")).when(external == F.lit(False), decide("rejected", "external_email_verifier_rejected"))
    by_mail = by_mail.when(external, decide("verified", "external_email_verifier_valid")).when(mx, decide("unknown", "domain_mx_valid_mailbox_unverified")).otherwise(decide("unknown", "email_syntax_valid_verification_unknown"))
    bad = lambda c: (text_or_empty(c["raw"]) != "") & (text_or_empty(c["value"]) == "")
    other = F.when(bad(phone), decide("rejected", "phone_invalid")).when(bad(linkedin), decide("rejected", "linkedin_invalid"))
    other = other.when((text_or_empty(phone["value"]) != "") | (text_or_empty(linkedin["value"]) != ""), decide("unknown", "sourced_contact_method_external_verification_unavailable"))
    return F.when((raw != "") & (mail == ""), decide("rejected", "email_empty_after_normalization")).when(mail != "", by_mail).otherwise(other.otherwise(decide("rejected", "no_valid_contact_method")))


def unpack_contact(c: Column | str) -> Column:
    """Name, role, email, email_likely and phone of a packed ``Name | Role | Email | Phone``; null if empty.

    Parts are told by their shape: the mailbox has an @, the phone is another part with seven digits or more.
    """
    raw = text_or_empty(c)
    parts = F.transform(F.split(raw, r"\|"), lambda p: F.btrim(p))
    first = lambda keep: F.coalesce(F.get(F.filter(parts, keep), F.lit(0)), F.lit(""))
    mail = first(lambda p: F.contains(p, F.lit("@")))
    phone = first(lambda p: ~F.contains(p, F.lit("@")) & (F.length(F.regexp_replace(p, "[^0-9]", "")) >= 7))
    name = F.get(parts, F.lit(0))
    role = F.filter(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda p: (p != "") & (p != name) & (p != mail) & (p != phone))
    out = F.struct(
        name.alias("name"),
        F.array_join(role, ", ").alias("role"),
        F.btrim(F.regexp_replace(mail, r"(?i)^likely\s+", "")).alias("email"),
        F.regexp_like(mail, F.lit(r"(?i)^likely\b")).alias("email_likely"),
        F.btrim(F.regexp_replace(phone, r"\s*\($", "")).alias("phone"),
    )
    return F.when(F.btrim(raw) != "", out)


def seniority(c: Column | str) -> Column:
    """Owner, c_suite, vp, director, manager or ''."""
    title = F.concat(F.lit(" "), F.lower(text_or_empty(c)), F.lit(" "))
    out = None
    for name, marks in SENIORITY:
        test = F.regexp_like(title, F.lit("|".join(m.replace(")", r"\)") for m in marks)))
        out = F.when(test, name) if out is None else out.when(test, name)
    return out.otherwise("")


def seniority_weight(c: Column | str) -> Column:
    label = seniority(c)
    return F.coalesce(F.create_map(*[F.lit(x) for item in SENIORITY_WEIGHT.items() for x in item])[label], F.lit(0))


def local_scope(c: Column | str) -> Column:
    return F.regexp_like(normalize_text(c), F.lit(LOCAL_SCOPES))


def role_score(title: Column | str, scope: Column | str) -> Column:
    """A struct of score, 0 to 115, and the rationale of each part."""
    said = normalize_text(F.concat_ws(" ", text_or_empty(title), text_or_empty(scope)))
    score, why = F.lit(0), F.lit("role_not_facilities_relevant")
    for points, name, pattern in reversed(ROLES):
        test = F.regexp_like(said, F.lit(pattern))
        score, why = F.when(test, F.lit(points)).otherwise(score), F.when(test, F.lit(name)).otherwise(why)
    works = F.regexp_like(normalize_text(scope), F.lit("facilit|property|operations"))
    near = local_scope(scope)
    rationale = F.array_compact(F.array(why, F.when(works, F.lit("scope_facilities_property_operations")), F.when(near, F.lit("scope_arizona_or_local"))))
    return F.struct((score + F.when(works, 10).otherwise(0) + F.when(near, 5).otherwise(0)).alias("score"), rationale.alias("rationale"))


def is_generic_person(c: Column | str) -> Column:
    """a role, a team or a single word rather than a person's name."""
    name = F.lower(F.btrim(text_or_empty(c)))
    tokens = F.split(squeeze(name), " ")
    last = F.regexp_replace(F.try_element_at(tokens, F.lit(-1)), "[.,]+$", "")
    return (name == "") | F.regexp_like(name, F.lit("|".join(GENERIC_TITLES))) | (F.size(tokens) < 2) | F.coalesce(last.isin(*GENERIC_LAST_WORDS), F.lit(False))


def mailbox_is_generic(c: Column | str) -> Column:
    local = F.regexp_replace(F.lower(F.substring_index(text_or_empty(c), "@", 1)), "[.-]", "")
    return local.isin(*LIST_GENERIC_LOCALS)


def reachable(email: Column | str, phone: Column | str) -> Column:
    """F15"""
    return (text_or_empty(email) != "") | (text_or_empty(phone) != "")


def eligible_for_verification(status: Column | str, reason: Column | str) -> Column:
    """verified, or unknown with a mail host that exists."""
    status, reason = text_or_empty(status), text_or_empty(reason)
    return (status == "verified") | ((status == "unknown") & (reason == "domain_mx_valid_mailbox_unverified"))


def split_name(c: Column | str) -> Column:
    """The first word and the rest."""
    name = squeeze(text_or_empty(c))
    return F.struct(F.substring_index(name, " ", 1).alias("first"), F.when(F.contains(name, F.lit(" ")), F.substring(name, F.instr(name, " ") + 1, F.length(name))).otherwise(F.lit("")).alias("rest"))


def verdict(c: Column | str) -> Column:
    """A provider's word for a mailbox as valid, invalid, catch_all or unknown."""
    said = F.lower(F.btrim(text_or_empty(c)))
    return F.when(F.regexp_like(said, F.lit("catch.?all|accept.?all")), "catch_all").when(said.isin("deliverable", "valid", "ok"), "valid").when(said.isin("undeliverable", "invalid", "rejected"), "invalid").otherwise("unknown")
