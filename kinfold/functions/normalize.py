"""Column expressions for contact fields."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Error codes, limits, patterns and domain tables of the published rules.
INVALID_PHONE = "invalid_phone_format"
EMAIL_NO_AT = "invalid_email_no_at"
EMAIL_MULTIPLE_AT = "invalid_email_multiple_at"
EMAIL_EMPTY_LOGIN = "invalid_email_empty_login"
EMAIL_EMPTY_DOMAIN = "invalid_email_empty_domain"
EMAIL_LOGIN_TOO_LONG = "invalid_email_login_too_long"
EMAIL_DOMAIN_TOO_LONG = "invalid_email_domain_too_long"
EMAIL_SPECIAL_CHARS = "invalid_email_special_chars"
MAX_LOGIN = 64
MAX_DOMAIN = 255
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
DOMAIN_TYPOS = {
    "gmai.com": "gmail.com",
    "qmail.com": "gmail.com",
    "gmal.com": "gmail.com",
}
DOMAIN_ALIASES = {
    "gmail.com": "gmail.com",
    "gmail.ru": "gmail.com",
    "mail.ru": "mail.ru",
    "bk.ru": "mail.ru",
    "list.ru": "mail.ru",
    "inbox.ru": "mail.ru",
    "xmail.ru": "mail.ru",
    "yandex.ru": "yandex.ru",
    "ya.ru": "yandex.ru",
    "yandex.com": "yandex.ru",
    "yandex.by": "yandex.ru",
}
MAIL_RU_FAMILY = ("mail.ru", "bk.ru", "list.ru", "inbox.ru", "xmail.ru")
YANDEX_FAMILY = ("yandex.ru", "ya.ru", "yandex.com", "yandex.by")
PHONE_FORMATS = (
    ("11_digits_7", r"^7\d{10}$"),
    ("11_digits_8", r"^8\d{10}$"),
    ("7_digits_local", r"^\d{7}$"),
)
INITIALS_PATTERN = r"^[А-ЯA-Z]\.$"
LATIN_PATTERN = r"[a-zA-Z]"
CYRILLIC_PATTERN = r"[а-яА-Я]"
UNKNOWN_LAST = "UNK"
UNKNOWN_FIRST = "XX"
# End of fixed values.


def _strip(col: Column) -> Column:
    return F.regexp_replace(col, r"(?U)^\s+|\s+$", "")


def _lookup(col: Column, table: dict[str, str]) -> Column:
    literal = F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())])
    return F.coalesce(F.try_element_at(literal, col), col)


def normalize_phone(col: Column) -> Column:
    """``+7`` and ten digits, an error code, or null for a blank value."""
    kept = F.regexp_replace(col, r"(?U)[^\d+]", "")
    kept = F.when(kept.startswith("8"), F.concat(F.lit("+7"), F.substring(kept, 2, 1 << 20))).otherwise(kept)
    return (
        F.when(col.isNull() | (_strip(col) == ""), F.lit(None).cast("string"))
        .when(kept.startswith("+7") & (F.length(kept) == 12), kept)
        .when(kept.startswith("7") & (F.length(kept) == 11), F.concat(F.lit("+"), kept))
        .otherwise(F.lit(INVALID_PHONE))
    )


def normalize_name(col: Column) -> Column:
    """Trimmed lower-case name with single spaces; only an empty value becomes null."""
    return F.when(F.length(col) > 0, F.regexp_replace(F.lower(_strip(col)), r"(?U)\s+", " "))


def normalize_email(col: Column) -> Column:
    """Canonical address, or the first error code that applies."""
    email = F.lower(_strip(col))
    parts = F.split(email, "@")
    login, domain = parts[0], F.get(parts, 1)
    canonical = _lookup(_lookup(domain, DOMAIN_TYPOS), DOMAIN_ALIASES)
    user = F.when(canonical == "gmail.com", F.replace(login, F.lit("."), F.lit(""))).otherwise(login)
    return (
        F.when(col.isNull() | (email == ""), F.lit(None).cast("string"))
        .when(~email.contains("@"), EMAIL_NO_AT)
        .when(F.size(parts) != 2, EMAIL_MULTIPLE_AT)
        .when(login == "", EMAIL_EMPTY_LOGIN)
        .when(domain == "", EMAIL_EMPTY_DOMAIN)
        .when(F.length(login) > MAX_LOGIN, EMAIL_LOGIN_TOO_LONG)
        .when(F.length(domain) > MAX_DOMAIN, EMAIL_DOMAIN_TOO_LONG)
        .when(~email.rlike(EMAIL_PATTERN), EMAIL_SPECIAL_CHARS)
        .otherwise(F.concat(user, F.lit("@"), canonical))
    )


def email_domain(col: Column) -> Column:
    """Text after the last ``@``; the whole text without one."""
    return F.element_at(F.split(col, "@"), -1)


def email_domain_or_empty(col: Column) -> Column:
    """Lower-case domain, empty text for null."""
    return F.coalesce(F.lower(email_domain(col)), F.lit(""))


def full_name(first: Column, last: Column) -> Column:
    """Null when either part is null."""
    return F.concat(first, F.lit(" "), last)


def display_name(first: Column, last: Column, null_text: str | None = None) -> Column:
    """The parts that exist; ``null_text`` writes missing parts as that word."""
    if null_text is not None:
        fill = F.lit(null_text)
        return _strip(F.concat(F.coalesce(first, fill), F.lit(" "), F.coalesce(last, fill)))
    return _strip(F.concat_ws(" ", first, last))


def phone_format(col: Column) -> Column:
    """Name of the first matching digit pattern, else ``other``."""
    digits = F.regexp_replace(F.coalesce(col, F.lit("")), r"(?U)\D", "")
    (name, pattern), *rest = PHONE_FORMATS
    chain_ = F.when(digits.rlike(pattern), name)
    for name, pattern in rest:
        chain_ = chain_.when(digits.rlike(pattern), name)
    return chain_.otherwise("other")


def phone_country(col: Column) -> Column:
    """First two characters."""
    return F.substring(col, 1, 2)


def phone_operator(col: Column) -> Column:
    """Characters three to five."""
    return F.substring(col, 3, 3)


def _present(col: Column) -> Column:
    return col.isNotNull() & (F.lower(col) != "nan") & (_strip(col) != "")


def name_block_key(first: Column, last: Column) -> Column:
    """Three letters of the last name and two of the first."""
    last_key = F.when(_present(last), F.upper(F.substring(last, 1, 3))).otherwise(UNKNOWN_LAST)
    first_key = F.when(_present(first), F.upper(F.substring(first, 1, 2))).otherwise(UNKNOWN_FIRST)
    return F.concat(last_key, F.lit("_"), first_key)


def has_name(first: Column, last: Column) -> Column:
    """At least one name part."""
    def known(c: Column) -> Column:
        return c.isNotNull() & (c != "nan")

    return known(first) | known(last)


def day_of_week(col: Column) -> Column:
    """Monday is 0."""
    return F.weekday(col)


def is_new_year_birthday(col: Column) -> Column:
    """The placeholder date 01.01."""
    return F.date_format(col, "dd.MM") == "01.01"


def to_number(col: Column) -> Column:
    """Null when the text is not a number."""
    return col.try_cast("double")


def to_timestamp(col: Column) -> Column:
    """Null when the text is not a time."""
    return col.try_cast("timestamp_ntz")
