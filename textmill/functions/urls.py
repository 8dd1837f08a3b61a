"""Column functions over URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..data import lines

_RULES = {rule for line in lines("suffixes.txt") for rule in line}
EXCEPTIONS = sorted(r[1:] for r in _RULES if r.startswith("!"))
WILDCARDS = sorted(r[2:] for r in _RULES if r.startswith("*."))
SUFFIXES = sorted(r for r in _RULES if r[0] not in "!*" and "." in r)


def host(url: Column) -> Column:
    """Lower-case host without user, port or final dot; null where there is none."""
    h = F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:@]+)", 1))
    return F.when(h != "", F.regexp_replace(h, r"\.+$", ""))


def path(url: Column) -> Column:
    p = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*([^?#]*)", 1)
    return F.when(p == "", F.lit("/")).otherwise(p)


def before_query(url: Column) -> Column:
    """All up to the first question mark."""
    return F.regexp_extract(url, r"^(.[^?]*)", 1)


def collapse_slashes(url: Column) -> Column:
    """Runs of slashes become one, but for those after the scheme."""
    return F.regexp_replace(url, r"(?<!:)/{2,}", "/")


def path_prefix(url: Column, longest: int = 16) -> Column:
    """The folder of the path, without a file name, and nothing beyond ``longest`` characters."""
    p = F.regexp_replace(path(collapse_slashes(url)), r"[^/]*\.[^/]*$", "")
    p = F.when(p == "", F.lit("/")).otherwise(p)
    return F.when(F.length(p) > longest, F.substring(p, 1, longest)).otherwise(p)


def surt(url: Column) -> Column:
    """Sort-friendly key: the host's labels in reverse, then the path."""
    labels = F.array_join(F.reverse(F.split(F.regexp_replace(host(url), r"^www\.", ""), r"\.")), ",")
    return F.concat(labels, F.lit(")"), F.lower(path(url)))


def _last(host: Column, labels: int) -> Column:
    """The last labels of a host; null where it has fewer."""
    return F.when(F.size(F.split(host, r"\.")) >= labels, F.substring_index(host, ".", -labels))


def _is_suffix(host: Column, labels: int) -> Column:
    own = _last(host, labels)
    found = own.isin(SUFFIXES) | (_last(host, labels - 1).isin(WILDCARDS) & ~own.isin(EXCEPTIONS)) | F.coalesce(_last(host, labels + 1).isin(EXCEPTIONS), F.lit(False))
    return F.coalesce(found, F.lit(False))


def public_suffix(host: Column) -> Column:
    """The longest suffix of a host under which names are registered: by the rules of data/suffixes.txt, else the last label; an address of digits is its own."""
    digits = host.rlike(r"^[0-9.]+$")
    return F.when(digits, host).when(_is_suffix(host, 3), _last(host, 3)).when(_is_suffix(host, 2), _last(host, 2)).otherwise(_last(host, 1))


def domain_of(host: Column) -> Column:
    """The suffix and a label more; the host where it has no more."""
    digits = host.rlike(r"^[0-9.]+$")
    found = F.when(_is_suffix(host, 3), _last(host, 4)).when(_is_suffix(host, 2), _last(host, 3)).otherwise(_last(host, 2))
    return F.when(digits, host).otherwise(F.coalesce(found, host))


def registered_domain(url: Column) -> Column:
    return domain_of(host(url))


def sql_suffix(host: str) -> tuple[str, str]:
    """(public suffix, registered domain) of a host as SQL."""

    def last(k: int) -> str:
        return f"(CASE WHEN len(string_split({host}, '.')) >= {k} THEN array_to_string(string_split({host}, '.')[-{k}:], '.') END)"

    def within(x: str, names: list[str]) -> str:
        return f"{x} IN (" + ", ".join(f"'{n}'" for n in names) + ")"

    def is_suffix(k: int) -> str:
        return f"coalesce({within(last(k), SUFFIXES)} OR ({within(last(k - 1), WILDCARDS)} AND NOT {within(last(k), EXCEPTIONS)}) OR coalesce({within(last(k + 1), EXCEPTIONS)}, false), false)"

    digits = f"regexp_full_match({host}, '[0-9.]+')"
    suffix = f"CASE WHEN {digits} THEN {host} WHEN {is_suffix(3)} THEN {last(3)} WHEN {is_suffix(2)} THEN {last(2)} ELSE {last(1)} END"
    domain = f"CASE WHEN {digits} THEN {host} ELSE coalesce(CASE WHEN {is_suffix(3)} THEN {last(4)} WHEN {is_suffix(2)} THEN {last(3)} ELSE {last(2)} END, {host}) END"
    return suffix, domain


def decode(c: Column) -> Column:
    """Percent-decoded, + as a blank; malformed text as it is."""
    return F.coalesce(F.try_url_decode(c), c)


def parameters(url: Column) -> Column:
    """The query's parameters as an array of (name, value), decoded, in their order; those without a value are left out."""
    parts = F.filter(F.split(F.regexp_extract(url, r"\?([^#]*)", 1), "&"), lambda p: F.contains(p, F.lit("=")) & ~p.rlike("=$"))
    return F.transform(parts, lambda p: F.struct(decode(F.substring_index(p, "=", 1)).alias("name"), decode(F.regexp_replace(p, "^[^=]*=", "")).alias("value")))


def keep_parameters(url: Column, names: dict[str, str]) -> Column:
    """The URL with only the named query parameters, renamed; in their order."""
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    keys = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    parts = F.filter(F.split(query, "&"), lambda p: F.substring_index(p, "=", 1).isin(*names) & F.contains(p, F.lit("=")))
    renamed = F.transform(parts, lambda p: F.concat(keys[F.substring_index(p, "=", 1)], F.lit("="), F.regexp_replace(p, "^[^=]*=", "")))
    return F.concat(before_query(F.regexp_replace(url, "#.*$", "")), F.when(F.size(renamed) > 0, F.concat(F.lit("?"), F.array_join(renamed, "&"))).otherwise(F.lit("")))
