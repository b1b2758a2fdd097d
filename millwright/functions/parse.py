"""Turning raw payload text into typed values.

Each rule is a piece of SQL over an expression given as text (a column name,
``payload['x']``, ...). ``*_sql`` returns the text, for ``selectExpr`` lists of many
columns; the function of the same name returns a Column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright import schemas as S


def words(values) -> str:
    """SQL list of text literals."""
    return ", ".join("'" + v.replace("'", "\\'") + "'" for v in values)


def text_map(pairs: dict[str, str]) -> str:
    """SQL map literal; looking up another key gives null."""
    return f"map({words(x for pair in pairs.items() for x in pair)})"


def clean_sql(e: str) -> str:
    return f"nullif(btrim({e}), '')"


def number_sql(e: str, trim: bool = True) -> str:
    text = f"btrim({e})" if trim else e
    return f"try_cast(nullif(regexp_extract({text}, r'{S.NUMBER_PATTERN}', 0), '') AS {S.EXACT.simpleString()})"


def int_sql(e: str, trim: bool = True) -> str:
    return f"try_cast(round({number_sql(e, trim)}, 0) AS int)"


def bool_sql(e: str) -> str:
    return f"lower({clean_sql(e)}) IN ({words(S.TRUE_WORDS)})"


def timestamp_sql(e: str) -> str:
    return f"try_cast(btrim(regexp_extract({e}, r'{S.DATE_PREFIX_PATTERN}', 0)) AS timestamp_ntz)"


def date_key_sql(e: str) -> str:
    return f"CAST(date_format({e}, 'yyyyMMdd') AS int)"


def clean_text(e: str) -> Column:
    """Trimmed text; blank becomes null."""
    return F.expr(clean_sql(e))


def parse_number(e: str, trim: bool = True) -> Column:
    """Plain decimal text to a number, anything else to null.

    ``trim=False`` keeps the stricter silver rule, where padding makes text invalid.
    """
    return F.expr(number_sql(e, trim))


def parse_int(e: str, trim: bool = True) -> Column:
    """Number rounded half away from zero."""
    return F.expr(int_sql(e, trim))


def parse_bool(e: str) -> Column:
    return F.expr(bool_sql(e))


def parse_timestamp(e: str) -> Column:
    """Wall-clock timestamp (any zone offset is dropped) of text that starts with a date."""
    return F.expr(timestamp_sql(e))


def date_key(e: str) -> Column:
    return F.expr(date_key_sql(e))


def coerce_number(c: Column) -> Column:
    """Lenient number: everything a double literal allows, else null."""
    return F.btrim(c.cast("string")).try_cast("double")


def missing_to_null(c: Column, markers: list[str] = S.MISSING_MARKERS) -> Column:
    return F.when(~c.isin(markers), c)


def safe_rate(numerator: str, denominator: str) -> Column:
    """Ratio rounded to 4 digits; null when either side is null or the divisor is 0."""
    kind = S.NUM.simpleString()
    return F.expr(f"round(CAST({numerator} AS {kind}) / nullif(CAST({denominator} AS {kind}), 0), 4)")


def with_shift(df: DataFrame, shift: str, ts: str) -> DataFrame:
    """Adds shift_id, shift_name, start_hour and end_hour, from shift text or else the hour.

    A missing timestamp counts as night. Each step is a projection of its own, so its
    result is computed once although the next step uses it several times.
    """
    by_word = text_map({w: key for key, (known, *_) in S.SHIFTS.items() for w in known})
    morning, afternoon, night = S.SHIFTS

    def detail(position: int, fallback: str) -> str:
        known = text_map({key: values[position] for key, values in S.SHIFTS.items()})
        return f"coalesce({known}[shift_id], {fallback})"

    keep = list(df.columns)
    return (
        df.selectExpr(*keep, f"lower({clean_sql(shift)}) AS _text", f"hour({ts}) AS _hour")
        .selectExpr(
            *keep,
            "_text",
            f"""coalesce({by_word}[_text], concat('SHIFT_', upper(replace(_text, ' ', '_'))),
                CASE WHEN _hour BETWEEN 6 AND 13 THEN '{morning}' WHEN _hour BETWEEN 14 AND 21 THEN '{afternoon}'
                ELSE '{night}' END) AS shift_id""",
        )
        .selectExpr(
            *keep,
            "shift_id",
            f"{detail(1, '_text')} AS shift_name",
            f"{detail(2, words(['00:00']))} AS start_hour",
            f"{detail(3, words(['23:59']))} AS end_hour",
        )
    )


def shift_from_hour(ts: str) -> Column:
    """Cleaning variant of the shift label; null timestamp gives null."""
    return F.expr(
        f"""CASE WHEN hour({ts}) BETWEEN 6 AND 13 THEN 'matin' WHEN hour({ts}) BETWEEN 14 AND 21 THEN 'apres_midi'
            WHEN {ts} IS NOT NULL THEN 'nuit' END"""
    )


def defect_parts_sql(kind: str, category: str, severity: str) -> tuple[str, str, str]:
    return (
        f"coalesce({clean_sql(kind)}, 'no_defect')",
        f"coalesce({clean_sql(category)}, 'none')",
        f"coalesce({clean_sql(severity)}, 'minor')",
    )


def defect_slug_sql(kind: str, category: str, severity: str) -> str:
    joined = ", ".join(defect_parts_sql(kind, category, severity))
    return f"btrim(regexp_replace(lower(concat_ws('_', {joined})), '[^a-z0-9]+', '_'), '_')"


def defect_slug(kind: str, category: str, severity: str) -> Column:
    return F.expr(defect_slug_sql(kind, category, severity))


def payload_map(json_text: Column) -> Column:
    """One parse of a JSON object into text values.

    The variant route keeps plain digits for small and large numbers and keeps keys
    whose value is null; ``from_json`` would do neither.
    """
    return F.parse_json(json_text).cast("map<string,string>")


def has_keys_sql(payload: str, keys: list[str]) -> str:
    return "(" + " AND ".join(f"map_contains_key({payload}, '{k}')" for k in keys) + ")"


def json_has_keys(payload: str, keys: list[str]) -> Column:
    return F.expr(has_keys_sql(payload, keys))


def payload_hash(envelope_json: Column) -> Column:
    """SHA-256 of the JSON with sorted keys."""
    return variant_hash(F.parse_json(envelope_json))


def variant_hash(value: Column) -> Column:
    """SHA-256 of a parsed JSON value, whose keys are sorted."""
    return F.sha2(F.to_json(value), 256)


def active_flags(payload: str) -> Column:
    """Names of the set ``flag_*`` keys, prefix removed, comma-joined in key order."""
    on = (
        f"map_filter({payload}, (k, v) -> startswith(k, 'flag_') "
        f"AND coalesce(lower(btrim(v)) IN ({words(S.TRUE_WORDS)}), false))"
    )
    names = f"transform(sort_array(map_keys({on})), k -> replace(k, 'flag_', ''))"
    return F.expr(f"nullif(array_join({names}, ','), '')")


def source_system_of(file_name: Column) -> Column:
    """File stem without its variant suffixes."""
    stem = F.regexp_replace(file_name, r"\.[^.]*$", "")
    return F.regexp_replace(stem, "(" + "|".join(S.VARIANT_SUFFIXES) + ")", "")


def business_sql(source_file: str) -> str:
    return f"(endswith({source_file}, '{S.BUSINESS_SUFFIX}') OR {source_file} = '{S.REALTIME_SOURCE_FILE}')"


def is_business_event(source_file: str) -> Column:
    return F.expr(business_sql(source_file))


def event_key_sql(*parts: str) -> str:
    """A repeatable 60-bit id for rows that have no single key column."""
    digest = f"md5(concat_ws('|', {', '.join(parts)}))"
    return f"CAST(conv(substring({digest}, 1, 15), 16, 10) AS bigint)"
