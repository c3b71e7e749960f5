"""Column expressions shared by the operators. Everything here stays inside the JVM."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import fixed_values as fv

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType, T.BooleanType)

# Decimal digits of other scripts that a numeric answer may be typed in.
_ZEROS = (0xFF10, 0x0660, 0x06F0, 0x0966, 0x09E6, 0x0E50)
_FOREIGN_DIGITS = "".join(chr(z + i) for z in _ZEROS for i in range(10))
_ASCII_DIGITS = "0123456789" * len(_ZEROS)

_NUMBER = r"[-+]?\d+(?:\.\d+)?"
_PLAIN_NUMBER = r"(?i)^[-+]?(?:(?:\d+(?:\.\d*)?|\.\d+)(?:e[-+]?\d+)?|inf|infinity)$"


def is_numeric(data_type: T.DataType) -> bool:
    return isinstance(data_type, NUMERIC_TYPES)


def sql_text(value: str) -> str:
    """SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text_array(values) -> Column:
    return F.expr("array(" + ", ".join(sql_text(v) for v in values) + ")")


def text_structs(rows, names) -> Column:
    """Array of structs of strings, e.g. the variables of numbered tests."""
    return F.expr("array(" + ", ".join(
        "named_struct(" + ", ".join(f"{sql_text(n)}, {sql_text(v)}" for n, v in zip(names, row)) + ")" for row in rows) + ")")


def number_sql(name: str, data_type: T.DataType) -> str:
    """Double with NaN turned into NULL; booleans count as 0/1. Wide tables build their plans from such text."""
    col = sql_name(name)
    if isinstance(data_type, T.BooleanType):
        return f"cast(cast({col} as int) as double)"
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return f"if(isnan({col}), null, cast({col} as double))"
    return f"cast({col} as double)"


def label_sql(name: str, data_type: T.DataType) -> str:
    """Text of a level; the same for every operator that treats a value as a category."""
    col = sql_name(name)
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return f"if(isnan({col}), null, cast({col} as string))"
    return f"cast({col} as string)"


def finite_sql(number: str) -> str:
    """NULL for +-inf as well: the rule for model inputs."""
    return f"if(abs({number}) = double('infinity'), null, {number})"


def finite(col: Column) -> Column:
    """NULL for NaN and +-inf: the rule for model inputs."""
    return F.when(~F.isnan(col) & (F.abs(col) != float("inf")), col)


def round6(col: Column) -> Column:
    """Rounded to 6 digits without negative zero."""
    return F.round(col.cast("double"), 6) + F.lit(0.0)


def strip(col: Column) -> Column:
    """Strip any Unicode white space, U+3000 included."""
    return F.regexp_replace(col, r"(?U)^\s+|\s+$", "")


def any_contains(haystack: Column, needles, east_asian: Column | None = None) -> Column:
    """Whether any needle occurs. Needles that contain another one are implied by it.

    ``east_asian`` tells whether the text has such characters at all; Chinese needles are only
    looked for there.
    """
    needles = list(dict.fromkeys(n.lower() for n in needles))
    needles = [n for n in needles if not any(m != n and m in n for m in needles)]
    plain = [n for n in needles if east_asian is None or n.isascii()]
    hit = F.lit(False)
    for needle in plain:
        hit = hit | F.contains(haystack, F.lit(needle))
    other = F.lit(False)
    for needle in needles:
        if needle not in plain:
            other = other | F.contains(haystack, F.lit(needle))
    return hit if len(plain) == len(needles) else hit | (east_asian & other)


def has_east_asian(text: Column) -> Column:
    return text.rlike(r"[\u2E80-\u9FFF\uFF00-\uFFEF]")


def answer_text(raw: Column) -> Column:
    """Stripped answer, NULL for missing tokens."""
    text = strip(raw)
    compact = F.lower(F.regexp_replace(raw, r"(?U)\s+", ""))
    return F.when(~compact.isin(*fv.MISSING_TOKENS), text)


def text_number(answer: Column, plain: bool = True) -> Column:
    """Number that an :func:`answer_text` stands for: Likert label, percentage, leading or trailing number.

    ``plain`` admits texts of over 12 characters that are a number as a whole. ``answer`` should be a
    plain column: it is used several times.
    """
    text = F.translate(answer, _FOREIGN_DIGITS, _ASCII_DIGITS)
    likert = F.expr("map(" + ", ".join(f"{sql_text(k)}, {v}D" for k, v in fv.LIKERT_MAP.items()) + ")")
    label = F.try_element_at(likert, F.lower(F.regexp_replace(answer, r"(?U)\s+", "")))
    percent = text.rlike(f"^{_NUMBER}%$")
    leading = F.regexp_extract(text, f"^({_NUMBER})", 1).try_cast("double")
    trailing = F.regexp_extract(text, f"({_NUMBER})$", 1).try_cast("double")
    short = percent | (F.length(answer) <= 12)
    worded = answer.rlike("|".join(fv.TRAILING_NUMBER_TOKENS))
    return F.coalesce(
        label,
        F.when(short, F.when(percent, leading / 100).otherwise(leading)),
        F.when(worded, trailing),
        *([F.when(text.rlike(_PLAIN_NUMBER), text.try_cast("double"))] if plain else []),
    )


def normalized_number(raw: Column) -> Column:
    return text_number(answer_text(raw))


def normalized_answer(raw: Column) -> Column:
    """Cleaned answer as text: numbers print as doubles, everything else, digit strings of over 12 characters too, stripped."""
    return answer_or_number(answer_text(raw))


def answer_or_number(answer: Column) -> Column:
    return F.coalesce(text_number(answer, plain=False).cast("string"), answer)


def matches_hints(low: Column, hints) -> Column:
    """Whole-name, token or snake-part match of a lower-cased name, or substring for hints of five letters and more.

    For a long hint the substring covers the rest; a short one must stand between characters that
    are neither letters nor digits, and a short compound between underscores or the ends.
    """
    hit = any_contains(low, [h for h in hints if len(h) >= 5])
    words = [h for h in hints if len(h) < 5 and "_" not in h]
    if words:
        hit = hit | low.rlike(f"(?<![a-z0-9])(?:{'|'.join(words)})(?![a-z0-9])")
    for h in hints:
        if len(h) < 5 and "_" in h:
            hit = hit | F.contains(F.concat(F.lit("_"), low, F.lit("_")), F.lit(f"_{h}_"))
    return hit
