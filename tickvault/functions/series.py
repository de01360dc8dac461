r"""Series keys `measurement,tag=value,...` and line protocol, as Column expressions.

A backslash takes the next character literally and is dropped; one at the very end stays. All functions give null for
null. Tags are split before they are unescaped, so an escaped `=` inside a tag key stays in the key.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickvault.functions.bind import let


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _raw_parts(text: Column, separator: str) -> Column:
    """Parts between separators that no backslash precedes, still escaped. A lone backslash at the end is a part's last character."""
    sep = f"\\x{ord(separator):02x}"
    # each part is met with the separator before it, so that empty parts count too
    return F.regexp_extract_all(F.concat(F.lit(separator), text), F.lit(rf"(?s){sep}((?:[^\\{sep}]|\\.|\\$)*+)"), F.lit(1))


def split_escaped(text: Column, separator: str) -> Column:
    """Parts of a text, unescaped."""
    return F.transform(_raw_parts(text, separator), unescape)


def split_first_escaped(text: Column, separator: str) -> Column:
    """(head, tail): before the first free separator, unescaped, and the raw rest; an empty tail if there is none."""
    sep = f"\\x{ord(separator):02x}"
    head = F.regexp_extract(text, rf"(?s)^((?:[^\\{sep}]|\\.|\\$)*+)", 1)
    # a lone backslash at the end of a head without a separator is no escape of anything and is dropped
    clean = F.regexp_replace(head, r"(?s)\\(.|$)", "$1")
    return F.when(text.isNotNull(), F.struct(clean.alias("head"), F.substring(text, F.length(head) + 2, F.length(text)).alias("tail")))


def parse_series_key(key: Column) -> Column:
    """struct<measurement, tags>; of a repeated tag the last value counts."""
    def parsed(parts: Column) -> Column:
        tags = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), _tag)
        return F.struct(unescape(F.element_at(parts, 1)).alias("measurement"), _map(tags).alias("tags"))

    return F.when(key.isNotNull(), let(_raw_parts(key, ","), parsed))


def _tag(part: Column) -> Column:
    pair = split_first_escaped(part, "=")
    return F.struct(pair["head"].alias("key"), unescape(pair["tail"]).alias("value"))


def _map(entries: Column) -> Column:
    """A map of entries, of which the last of a key counts."""
    later = lambda all_, e, i: F.exists(F.slice(all_, i + 2, F.size(all_)), lambda x: x["key"] == e["key"])
    return let(entries, lambda all_: F.map_from_entries(F.filter(all_, lambda e, i: ~later(all_, e, i))))


def series_key(measurement: Column, tags: Column) -> Column:
    """The text form of a measurement and its tags, sorted by key and escaped."""
    safe = lambda c: F.regexp_replace(c, r"([\\,= ])", r"\\$1")
    sorted_tags = F.array_sort(F.map_entries(tags))
    return F.concat_ws(",", F.regexp_replace(measurement, r"([\\, ])", r"\\$1"), F.transform(sorted_tags, lambda e: F.concat(safe(e["key"]), F.lit("="), safe(e["value"]))))


def quote_ident(text: Column) -> Column:
    return F.concat(F.lit('"'), F.regexp_replace(text, r'(["\\])', r"\\$1"), F.lit('"'))


def quote_string(text: Column) -> Column:
    return F.concat(F.lit("'"), F.regexp_replace(text, r"(['\\])", r"\\$1"), F.lit("'"))


#: Characters that have no place in a name of a dataset.
UNSAFE = '/\\:*?"<>|'


def sanitize_name(text: Column) -> Column:
    safe = F.translate(F.regexp_replace(text, r"^\s+|\s+$", ""), UNSAFE, "_" * len(UNSAFE))
    return F.when(F.length(safe) == 0, F.lit("series")).otherwise(safe)


def composite_key(key: Column) -> Column:
    """struct<series, field> of a storage key; without its separator the whole is the series."""
    at = F.instr(key, "#!~#")
    return F.when(at > 0, F.struct(F.substring(key, F.lit(1), at - 1).alias("series"), F.substring(key, at + 4, F.length(key)).alias("field"))).otherwise(F.struct(key.alias("series"), F.lit("").alias("field")))


def ids_in(text: Column, measurement: str, tag: str = "instId") -> Column:
    """The sorted distinct values of the tag in all keys of the measurement that occur in a text, such as the dump of an index."""
    pattern = rf"{re.escape(measurement)},{re.escape(tag)}=([^,\s]+)"
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), unescape)))


def preview(text: Column, limit: int = 120) -> Column:
    """A text for a report, cut to `limit` characters, the last three of which are dots then."""
    return F.when(F.length(text) <= limit, text).otherwise(F.concat(F.substring(text, 1, limit - 3), F.lit("...")))


def contract_month(contract: Column) -> Column:
    """struct<bucket, regex> of `underlying-DDMONYY-...`, with four parts or more; other ids are an error."""
    parts = F.split(contract, "-")
    month = F.regexp_extract(F.upper(F.get(parts, F.lit(1))), r"^\d{1,2}([A-Z]{3}\d{2})$", 1)
    ok = (F.size(parts) >= 4) & (month != "")
    under = F.get(parts, F.lit(0))
    quoted = F.regexp_replace(under, r"([^A-Za-z0-9_])", r"\\$1")
    found = F.struct(F.concat(under, F.lit("-"), month).alias("bucket"), F.concat(F.lit("^"), quoted, F.lit("-[0-9]{1,2}"), month, F.lit("-")).alias("regex"))
    return F.when(contract.isNull(), None).when(ok, found).otherwise(F.raise_error(F.concat(F.lit("no contract month in "), contract)).cast("struct<bucket: string, regex: string>"))


def file_name(path: Column) -> Column:
    """struct<generation, sequence> of `<generation>-<sequence>.tsm`; null for other names."""
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    hit = name.rlike(r"^\d+-\d+\.tsm$")
    part = lambda i: F.regexp_extract(name, r"^(\d+)-(\d+)\.tsm$", i).try_cast("bigint")
    return F.when(hit, F.struct(part(1).alias("generation"), part(2).alias("sequence")))


def wal_segment(path: Column) -> Column:
    """The number of a log segment `_<n>.wal`; null for other names."""
    return F.nullif(F.regexp_extract(path, r"(?:^|/)_(\d+)\.wal$", 1), F.lit("")).try_cast("bigint")


def lp_value(raw: Column) -> Column:
    """struct<kind, s, l, d, b> of a field value in line protocol: a quoted text, an integer with `i`, a truth value, a
    number, or else the raw text."""
    string = "string"
    quoted = raw.rlike(r'(?s)^".*"$') & (F.length(raw) > 1)
    whole = raw.rlike(r"^[+-]?\d+i$")
    true, false = raw.isin("t", "T", "true", "TRUE"), raw.isin("f", "F", "false", "FALSE")
    number = F.when(raw.rlike(r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"), F.trim(raw).try_cast("double"))
    made = lambda kind, s=None, n=None, d=None, b=None: F.struct(F.lit(kind).alias("kind"), *[(F.lit(None) if x is None else x).cast(t).alias(a) for x, t, a in ((s, string, "s"), (n, "bigint", "l"), (d, "double", "d"), (b, "boolean", "b"))])
    text = unescape(F.substring(raw, F.lit(2), F.length(raw) - 2))
    return F.when(raw.isNull(), None).when(quoted, made("string", s=text)).when(whole, made("integer", n=F.rtrim(raw, F.lit("i")).try_cast("bigint"))).when(true | false, made("boolean", b=true)).when(number.isNotNull(), made("float", d=number)).otherwise(made("string", s=raw))


def lp_line(line: Column, measurement: str) -> Column:
    """struct<tags, fields, time_ns> of a line, with any noise before the measurement left out; null where there is no such line.

    The head ends at the first space and the time begins after the last one that no quotes hold and no backslash precedes."""
    token = r'(?:[^\\" ]|\\.|"(?:[^\\"]|\\.)*+")*+'
    whole = rf"(?s)^({token}) ((?:{token} )*)"
    clean = F.regexp_replace(line, r"[\r\n]+$", "")
    start = F.instr(clean, measurement + ",")

    def fields_of(middle: Column) -> Column:
        raw = F.regexp_extract_all(F.concat(F.lit(","), F.rtrim(middle)), F.lit(r'(?s),((?:[^\\",]|\\.|"(?:[^\\"]|\\.)*+")*+)'), F.lit(1))
        pairs = F.filter(F.transform(raw, lambda r: split_first_escaped(r, "=")), lambda p: (p["head"] != "") & (p["tail"] != ""))
        return _map(F.transform(pairs, lambda p: F.struct(p["head"].alias("key"), lp_value(p["tail"]).alias("value"))))

    def cut(text: Column) -> Column:
        return F.struct(F.regexp_extract(text, whole, 1).alias("head"), F.regexp_extract(text, whole, 2).alias("middle"), text.alias("text"))

    def timed(c: Column) -> Column:
        time = F.substring(c["text"], F.length(c["head"]) + F.length(c["middle"]) + 2, F.length(c["text"]))
        good = (c["middle"] != "") & time.rlike(r"^\s*[+-]?\d+\s*$")
        return F.when(good, F.struct(parse_series_key(c["head"]).alias("k"), fields_of(c["middle"]).alias("f"), F.trim(time).try_cast("bigint").alias("t")))

    def made(c: Column) -> Column:
        right = (c["k"]["measurement"] == measurement) & (F.size(c["f"]) > 0)
        return F.when(right, F.struct(c["k"]["tags"].alias("tags"), c["f"].alias("fields"), c["t"].alias("time_ns")))

    text = F.when(start > 0, F.substring(clean, start, F.length(clean)))
    return let(text, lambda t: let(cut(t), lambda c: let(timed(c), made)))
