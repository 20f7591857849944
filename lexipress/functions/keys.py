"""Keys and small values: hosts, sources, JSON, numbers, times."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN_SOURCE = "unknown_source"
RANKING_KINDS = ("source", "domain", "source_type")
#: Other names of the kinds of ranking keys.
KIND_ALIASES = {"источник": "source", "домен": "domain", "url_domain": "domain", "host": "domain", "тип источника": "source_type", "тип_источника": "source_type", "source type": "source_type", "type": "source_type"}
#: Other names of source types.
TYPE_ALIASES = {
    "блоги": "блог", "blog": "блог", "blogs": "блог", "мессенджер": "мессенджеры", "соц сеть": "соц сети", "соцсеть": "соц сети", "соцсети": "соц сети",
    "социальная сеть": "соц сети", "социальные сети": "соц сети", "видеохостинги": "видеохостинг", "форум": "форумы", "отзыв": "отзывы", "микроблоги": "микроблог",
}
#: Payload keys that may hold a source type.
TYPE_KEYS = ("source_type", "sourceType", "source_kind", "sourceKind", "media_type", "mediaType", "category", "type")


def first_filled(*values: Column) -> Column:
    """First value that is not null or blank, trimmed; else the empty text."""
    return F.coalesce(*(F.nullif(F.trim(v), F.lit("")) for v in values), F.lit(""))


def distinct_filled(*values: Column) -> Column:
    """Values that are not null or empty, first occurrences only, in order."""
    return F.array_distinct(F.filter(F.array(*values), lambda v: v.isNotNull() & (v != "")))


def mapped(value: Column, aliases: dict[str, str]) -> Column:
    pairs = [F.lit(x) for kv in aliases.items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), value), value)


def text_key(value: Column) -> Column:
    """Lower case, one blank between words."""
    return F.regexp_replace(F.lower(F.trim(F.coalesce(value, F.lit("")))), r"\s+", " ")


def net_location(url: Column) -> Column:
    """Host and port of an absolute URL in lower case; else empty."""
    return F.lower(F.regexp_extract(F.trim(F.coalesce(url, F.lit(""))), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def domain_key(url: Column) -> Column:
    """Host without www, user and port; a bare name is its own host."""
    raw = F.trim(F.coalesce(url, F.lit("")))
    host = F.regexp_extract(raw, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#:@]*)", 1)
    host = F.regexp_replace(F.lower(F.when(host == "", raw).otherwise(host)), r"^[.\s]+|[.\s]+$", "")
    return F.regexp_replace(host, r"^www\.", "")


def source_name(metadata: Column, url: Column) -> Column:
    """Source in JSON metadata, else the URL's domain, else unknown_source."""
    named = F.nullif(F.trim(F.get_json_object(metadata, "$.source")), F.lit(""))
    return F.coalesce(named, F.nullif(domain_key(url), F.lit("")), F.lit(UNKNOWN_SOURCE))


def ranking_kind(value: Column) -> Column:
    """One of RANKING_KINDS, else empty."""
    kind = mapped(F.replace(text_key(value), F.lit("-"), F.lit("_")), KIND_ALIASES)
    return F.when(kind.isin(*RANKING_KINDS), kind).otherwise("")


def source_type_key(value: Column) -> Column:
    return mapped(text_key(value), TYPE_ALIASES)


def ranking_key(kind: Column, value: Column) -> Column:
    return F.when(kind == "domain", domain_key(value)).when(kind == "source_type", source_type_key(value)).otherwise(text_key(value))


def document_keys(url: Column, source: Column, payload: Column, metadata: Column) -> dict[str, Column]:
    """Keys of a document by ranking kind, as arrays."""
    json = lambda c, k: F.get_json_object(c, f"$.{k}")
    types = [source_type_key(json(c, k)) for c in (metadata, payload) for k in TYPE_KEYS]
    return {
        "source": distinct_filled(text_key(json(metadata, "source")), text_key(json(payload, "source")), text_key(source)),
        "domain": distinct_filled(domain_key(url), domain_key(json(payload, "url")), domain_key(json(metadata, "url"))),
        "source_type": distinct_filled(*types),
    }


def importance(value: Column) -> Column:
    """First digits of a text as a number; JSON true and false are none."""
    text = value.cast("string")
    digits = F.regexp_extract(text, r"(\d+)", 1)
    return F.when(~F.lower(text).isin("true", "false") & (digits != ""), digits.try_cast("int"))


def json_object(value: Column) -> Column:
    """The text if it is a JSON object, else '{}'."""
    return F.when(F.try_parse_json(value).isNotNull() & F.startswith(F.ltrim(value), F.lit("{")), value).otherwise("{}")


def has_json_key(value: Column, key: str) -> Column:
    """Whether a JSON object has a key, be its value null."""
    return F.coalesce(F.array_contains(F.json_object_keys(value), key), F.lit(False))


def unix_seconds(value: Column) -> Column:
    """Seconds since 1970 as text to a timestamp; null if they are none."""
    return F.timestamp_seconds(F.trim(value.cast("string")).try_cast("bigint"))


def day_span(start: Column, end: Column) -> Column:
    """dd-mm-YYYYtodd-mm-YYYY"""
    return F.concat(F.date_format(start, "dd-MM-yyyy"), F.lit("to"), F.date_format(end, "dd-MM-yyyy"))


def session_key(*parts: Column) -> Column:
    """Parts joined by '-', everything but letters, digits, '-' and '_' as '-'."""
    return F.regexp_replace(F.concat_ws("-", *parts), r"[^A-Za-z0-9_-]+", "-")


def step_goal(step: Column) -> Column:
    """Goal number at the end of a step's name (``…-kr-7``)."""
    return F.regexp_extract(step, r"-kr-(\d+)$", 1).try_cast("int")


def int_like(value: Column) -> Column:
    """An integer, or a text of digits only; else null."""
    text = F.trim(value.cast("string"))
    return F.when(text.rlike(r"^-?\d+$"), text.try_cast("bigint"))


def goal_of_file(path: Column) -> Column:
    """First number of a file's name."""
    return F.regexp_extract(F.element_at(F.split(path, "/"), -1), r"(\d+)", 1).try_cast("int")


def row_fingerprint(title: Column, text: Column) -> Column:
    """sha1 of the compact JSON list of two texts."""
    quoted = lambda c: F.regexp_replace(F.to_json(F.array(F.coalesce(c, F.lit("")))), r"^\[|\]$", "")
    return F.sha1(F.concat(F.lit("["), quoted(title), F.lit(","), quoted(text), F.lit("]")).cast("binary"))


def token_estimate(texts: Sequence[Column]) -> Column:
    """A third of the characters and fifty."""
    return F.floor(sum((F.length(t) for t in texts), F.lit(0)) / 3) + 50


def retry_after(error: Column) -> Column:
    """Seconds that an error text asks to wait."""
    return F.regexp_extract(F.lower(error), r"(?:retry[- ]after|try again in)\D{0,3}(\d+(?:\.\d+)?)", 1).try_cast("double")


def over_capacity(error: Column) -> Column:
    """Whether an error text tells of rate limits or overload."""
    return F.lower(error).rlike(r"rate.?limit|too many requests|\b429\b|overloaded|capacity|quota")


def fill_template(template: Column, values: dict[str, Column]) -> Column:
    """A prompt with its {{placeholders}} replaced."""
    for name, value in values.items():
        template = F.replace(template, F.lit("{{" + name + "}}"), value)
    return template


def hits_bucket(n: Column) -> Column:
    return F.when(n <= 1, "1").when(n == 2, "2").when(n <= 4, "3-4").when(n <= 9, "5-9").otherwise("10+")


def drawn(key: str, seed: int) -> Column:
    """A hash that orders rows at random, the same for a seed."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")).cast("binary"))
