"""Identifiers and addresses as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

ID_WIDTH = 10
URL_PARTS = r"\A[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::[^/?#]*)?([^?#;]*)"


def hash_id(value: Column) -> Column:
    """SHA-256 of the trimmed value, zero-padded to ten characters when shorter.
    Longer values stay whole (``lpad`` alone would cut them)."""
    trimmed = strip(value)
    padded = F.when(F.length(trimmed) < ID_WIDTH, F.lpad(trimmed, ID_WIDTH, "0")).otherwise(trimmed)
    return F.sha2(padded, 256)


def hash_id_or_null(value: Column) -> Column:
    return F.when(strip(value) != "", hash_id(value))


def _with_scheme(url: Column) -> Column:
    return F.when(F.rlike(url, F.lit(r"\Ahttps?://")), url).otherwise(F.concat(F.lit("http://"), url))


def package_name(url: Column, store_host: str) -> Column:
    """Last path segment when the host is the store's."""
    full = _with_scheme(url)
    path = F.regexp_replace(F.regexp_extract(full, URL_PARTS, 2), r"/+\z", "")
    return F.when(package_status(url, store_host).isNull(), F.regexp_extract(path, r"([^/]*)\z", 1))


def package_status(url: Column, store_host: str) -> Column:
    """Null when the address is usable, else ``host-error`` or ``url-error``."""
    host = F.lower(F.regexp_extract(_with_scheme(url), URL_PARTS, 1))
    broken = F.contains(host, F.lit("[")) != F.contains(host, F.lit("]"))
    return F.when(url.isNull() | broken, "url-error").when(host != store_host, "host-error")


def domain_gate(url: Column, store_host: str) -> Column:
    """``Bad-URL`` unless the part after ``//`` is exactly the store's host."""
    host = F.get(F.split(url, "/"), F.lit(2))
    return F.when(F.coalesce(host != store_host, F.lit(True)), "Bad-URL")


def canonical_url(url: Column) -> Column:
    """Cut at the language parameter and ask for English."""
    return F.concat(F.get(F.split(url, r"\?l="), F.lit(0)), F.lit("?l=en"))
