"""URLs: identity, domains, sources, categories, pagination and links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from heronlake.functions.categories import lookup_expression
from heronlake.functions.text import trimmed
from heronlake.functions.vocab import CATEGORY_GROUPS, SOURCES

#: scheme, authority, path
_SPLIT = r"^(?:([a-zA-Z][a-zA-Z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)"


def authority(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _SPLIT, 2)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _SPLIT, 3)


def normalize_url(url: Column) -> Column:
    """Without fragment; where the path ends in a slash, without the last character (of a query too: ids depend on it)."""
    bare = F.substring_index(trimmed(F.coalesce(url, F.lit(""))), "#", 1)
    slash = path(bare).endswith("/") & (F.length(path(bare)) > 1)
    return F.when(slash, F.left(bare, F.length(bare) - 1)).otherwise(bare)


def stable_id(url: Column) -> Column:
    return F.md5(normalize_url(url))


def domain(url: Column) -> Column:
    return F.replace(F.lower(authority(url)), F.lit("www."), F.lit(""))


def source_of(domain_name: Column, sources: dict[str, str] = SOURCES) -> Column:
    """The name of a domain: an equal key first, then the first key that the domain ends with, else the domain."""
    name = F.replace(F.lower(domain_name), F.lit("www."), F.lit(""))
    exact = F.coalesce(*(F.when(name == k, v) for k, v in sources.items()))
    ending = F.coalesce(*(F.when(name.endswith(k), v) for k, v in sources.items()))
    return F.coalesce(exact, ending, name)


def category_of_url(url: Column, groups: dict[str, list[str]] = CATEGORY_GROUPS) -> Column:
    """Of the first two parts of the path the first that is a known category (without a number at its end), else the
    first part."""
    parts = F.filter(F.split(path(url), "/"), lambda p: p != "")
    plain = F.transform(F.slice(parts, 1, 2), lambda p: F.regexp_replace(p, r"-[0-9]+$", ""))
    known = F.filter(plain, lambda p: lookup_expression(p, groups) != "other")
    return F.coalesce(F.try_element_at(known, F.lit(1)), F.try_element_at(parts, F.lit(1)), F.lit(""))


def page_url(category_url: Column, page: Column, template: str) -> Column:
    """The URL of a category's n-th page; template holds {base} and {page}."""
    base = F.when(category_url.rlike(r"\.html?$"), F.regexp_replace(category_url, r"\.html?$", "")).otherwise(F.regexp_replace(category_url, r"/+$", ""))
    made = F.replace(F.replace(F.lit(template), F.lit("{base}"), base), F.lit("{page}"), page.cast("string"))
    return F.when(page == 1, category_url).otherwise(made)


def article_links(html: Column, base: Column, pattern: str) -> Column:
    """Distinct normalised links of a page to its own domain that match pattern, without their query."""
    hrefs = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r"(?is)<a\s[^>]*?href\s*=\s*[\"']([^\"']*)[\"']"), F.lit(1))
    scheme = F.regexp_extract(base, _SPLIT, 1)
    root = F.concat(scheme, F.lit("://"), authority(base))
    folder = F.regexp_replace(F.concat(root, F.when(path(base) == "", "/").otherwise(path(base))), r"[^/]*$", "")

    def resolve(h: Column) -> Column:
        return (
            F.when(h.rlike(r"^[a-zA-Z][a-zA-Z0-9+.\-]*:"), h).when(h.startswith("//"), F.concat(scheme, F.lit(":"), h))
            .when(h.startswith("/"), F.concat(root, h)).otherwise(F.concat(folder, h))
        )

    full = F.transform(F.filter(F.transform(hrefs, trimmed), lambda h: h != ""), lambda h: F.substring_index(resolve(h), "?", 1))
    return F.array_distinct(F.transform(F.filter(full, lambda u: (domain(u) == domain(base)) & u.rlike(pattern)), normalize_url))
