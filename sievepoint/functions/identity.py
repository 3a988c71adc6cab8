"""Email, postal, phone and network address features."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _piece(text: Column, pattern: str, index: int) -> Column:
    return F.get(F.split(text, pattern), F.lit(index))


def email_stripped(email: Column) -> Column:
    return F.regexp_replace(F.lower(email), r"[^\w]", "")


def email_domain(email: Column) -> Column:
    return _piece(F.lower(email), "@", 1)


def email_handle(email: Column) -> Column:
    return _piece(F.lower(email), "@", 0)


def short_domain(domain: Column) -> Column:
    """Second dot label."""
    return _piece(domain, "[.]", 1)


def last_label(email: Column) -> Column:
    """Last dot label of the whole address, so text without a dot yields itself."""
    return F.split_part(F.lower(email), F.lit("."), F.lit(-1))


def postal_number(code: Column) -> Column:
    """First part before ``.`` or ``-``, every letter and mark as 0, as a number; missing is 0."""
    head = _piece(F.coalesce(code, F.lit("nan")), "[.-]", 0)
    return F.regexp_replace(head, "[a-zA-Z -,/:]", "0").try_cast("double")


def area_code(phone: Column) -> Column:
    return _piece(phone, " ", 0)


def known_address(ip: Column) -> Column:
    return F.when(ip == "unknown", "000.000.000.000").otherwise(ip)


def address_part(ip: Column, index: int) -> Column:
    return _piece(ip, "[.]", index)


def address_number(ip: Column) -> Column:
    """Base-256 number of the last four parts; fewer parts or other text is NULL."""
    parts = F.split(ip, "[.]")
    tail = F.slice(parts, -4, 4)
    total = F.lit(0).cast("long")
    for i in range(4):
        total = total * 256 + F.get(tail, F.lit(i)).try_cast("long")
    return F.when(F.size(parts) >= 4, total)
