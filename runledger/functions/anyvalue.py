"""OTLP any-values: attribute lookup, text coercion and conversion to JSON.

The functions take the any-value as SQL text, usually a column name, because
they are long and Spark parses one text far faster than it builds the same
expression call by call.

Scalars, flat arrays and flat key/value lists, which is nearly all log data, are
converted from their types.  Values nested deeper are folded as text, level by level,
in rows that have them and no others.  Nothing leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def attr(attributes: Column | str, key: str) -> Column:
    """Any-value of the first attribute called ``key``; NULL if there is none."""
    listed = F.col(attributes) if isinstance(attributes, str) else attributes
    # Position 0 is "not found", and there is nothing at index -1.
    return F.get(listed, F.array_position(listed["key"], key) - 1)["value"]


def _double_text(d: str) -> str:
    # 38 digits hold 21 before the point and 17 behind, or 24 leading zeros and digits.
    return f"""CASE
        WHEN isnan({d}) THEN 'NaN'
        WHEN {d} = double('inf') THEN '+Inf'
        WHEN {d} = double('-inf') THEN '-Inf'
        WHEN {d} = 0 THEN regexp_replace(string({d}), '[.]0$', '')
        WHEN abs({d}) >= 1 AND abs({d}) < 1e21
          THEN regexp_replace(string(try_cast(string({d}) AS decimal(38,17))), '[.]?0+$', '')
        WHEN abs({d}) < 1 AND abs({d}) >= 1e-6
          THEN regexp_replace(string(try_cast(string({d}) AS decimal(38,24))), '[.]?0+$', '')
        ELSE regexp_replace(regexp_replace(string({d}), '([.]0)?E-', 'e-'), '([.]0)?E', 'e+')
      END"""


def double_text(d: str) -> Column:
    """JSON number text of a double: shortest digits, no '.0', exponents only below
    1e-6 and from 1e21 on; NaN and the infinities print as NaN, +Inf and -Inf."""
    return F.expr(_double_text(d))


def _scalar_text(v: str) -> str:
    # Bytes are base64 text in OTLP/JSON, and just so in JSON.
    return (
        f"coalesce({v}.stringValue, string({v}.boolValue), {v}.intValue, "
        f"{_double_text(f'{v}.doubleValue')}, {v}.bytesValue)"
    )


def _scalar_json(v: str) -> str:
    """Variant of a scalar; NULL for anything else and for NaN and infinities."""
    return (
        f"coalesce(CAST({v}.stringValue AS variant), CAST({v}.boolValue AS variant), "
        f"CAST(try_cast({v}.intValue AS bigint) AS variant), "
        f"try_parse_json({_double_text(f'{v}.doubleValue')}), CAST({v}.bytesValue AS variant))"
    )


def _is_container(v: str) -> str:
    return f"({v}.arrayValue IS NOT NULL OR {v}.kvlistValue IS NOT NULL)"


def _is_deep(v: str) -> str:
    """True for containers that hold containers, numbers without a JSON form or a key twice."""

    def not_flat(e):
        d = f"{e}.doubleValue"
        return f"coalesce({_is_container(e)} OR isnan({d}) OR abs({d}) = double('inf'), false)"

    entries = f"{v}.kvlistValue.values"
    return f"""coalesce(
        exists({v}.arrayValue.values, e -> {not_flat("e")}),
        exists({entries}, e -> {not_flat("e.value")}) OR size(array_distinct({entries}.key)) < size({entries}),
        false)"""


def _flat_json(v: str) -> str:
    """Variant of a flat container; NULL for anything else."""

    def element(e):
        return f"coalesce({_scalar_json(e)}, parse_json('null'))"

    entry = f"named_struct('key', coalesce(e.key, ''), 'value', {element('e.value')})"
    return f"""CASE
        WHEN {_is_deep(v)} THEN NULL
        WHEN {v}.arrayValue IS NOT NULL THEN coalesce(
          to_variant_object(transform({v}.arrayValue.values, e -> {element("e")})), parse_json('[]'))
        WHEN {v}.kvlistValue IS NOT NULL THEN coalesce(
          to_variant_object(map_from_entries(transform({v}.kvlistValue.values, e -> {entry}))), parse_json('{{}}'))
      END"""


# A string literal is opaque while containers are folded: characters that mean something outside of strings are
# replaced inside by control characters, which JSON text never has as such.  So are those of folded containers.
_ESCAPED, _QUOTE = r"\u0001", r"\u0002"
_STRUCTURE, _IN_STRINGS = "{}[],:", r"\u0003\u0004\u0005\u0006\u0007\u0008"
_FOLDED = {"[": r"\u000E", "]": r"\u000F", ",": r"\u0010", ":": r"\u0011", "{": r"\u0012", "}": r"\u0013"}

# Kinds that are named but null beside another.
_NAMED_ONLY = [
    (r'"(?:string|bool|int|double|bytes|array|kvlist)Value":null,', ""),
    (r',"(?:string|bool|int|double|bytes|array|kvlist)Value":null', ""),
]
# What becomes of any-values that hold no other, in this order.
_SIMPLE = [
    (r'"(array|kvlist)Value":(?:null|\{\}|\{"values":null\})', '"$1Value":{"values":[]}'),
    (r'\{"(?:string|bool|int|double|bytes)Value":null\}', "null"),
    (r'\{"(?:string|bytes)Value":("[^"]*")\}', "$1"),
    (r'\{"boolValue":(true|false)\}', "$1"),
    (r'\{"intValue":"?\+?(-?)0*([0-9]+)"?\}', "$1$2"),
    (r"\{\}", "null"),
]
_DOUBLE = r'\{"doubleValue":"?([-+0-9.eE]+)"?\}'
# Entries of a key/value list whose values are folded, and containers whose elements all are.
_ENTRIES = [
    (r'\{"key":("[^"]*"),"value":([^{}\[\]]*)\}', "$1:$2"),
    (r'\{"key":("[^"]*")\}', "$1:null"),
    (r'\{"value":([^{}\[\]]*)\}', '"":$1'),
]
_INNERMOST = r'\{"(?:array|kvlist)Value":\{"values":\[[^{}\[\]]*\]\}\}'


def _let(value: str, name: str, use: str) -> str:
    """``use`` with ``name`` standing for ``value``, which is worked out once."""
    return f"element_at(transform(array({value}), {name} -> {use}), 1)"


def _replaced(text: str, pairs: list[tuple[str, str]]) -> str:
    for pattern, by in pairs:
        text = f"regexp_replace({text}, r'{pattern}', r'{by}')"
    return text


def _opaque(text: str) -> str:
    return f"translate({text}, ',:', '{_FOLDED[',']}{_FOLDED[':']}')"


def _folded_container(p: str) -> str:
    """An innermost container as plain JSON; of a repeated key the last entry stays."""
    inner = rf"regexp_extract({p}, r'(?s)\[(.*)\]', 1)"
    later = "exists(slice(es, i + 2, size(es)), x -> split_part(x, ':', 1) = split_part(e, ':', 1))"
    unique = f"IF(size(array_distinct(transform(es, e -> split_part(e, ':', 1)))) = size(es), es, filter(es, (e, i) -> NOT {later}))"
    entries = _let(f"split({inner}, ',')", "es", f"array_join({unique}, ',')")
    return (
        f"IF(startswith({p}, '{{\"arrayValue\"'), concat('{_FOLDED['[']}', {_opaque(inner)}, '{_FOLDED[']']}'), "
        f"concat('{_FOLDED['{']}', {_opaque(entries)}, '{_FOLDED['}']}'))"
    )


def _plain_json(text: str) -> str:
    """JSON text of a nested any-value as plain JSON text; NULL where it has none.

    Containers are folded from the inside out, one level per step, as many steps as braces are nested, whatever the
    depth.  What is left unfolded in the end, such as NaN, has no JSON form.
    """
    pieces = rf"split(replace(replace({text}, r'\\', '{_ESCAPED}'), r'\"', '{_QUOTE}'), '\"')"
    hidden = f"array_join(transform({pieces}, (s, i) -> IF(i % 2 = 1, translate(s, '{_STRUCTURE}', '{_IN_STRINGS}'), s)), '\"')"
    number = _double_text("try_cast(x AS double)")
    literal = r"""concat(r'\{"doubleValue":"?\Q', x, r'\E"?\}')"""
    doubles = f"aggregate(array_distinct(regexp_extract_all(h, r'{_DOUBLE}', 1)), h, (t, x) -> regexp_replace(t, {literal}, {number}))"
    simple = _let(_replaced(hidden, _NAMED_ONLY), "h", _replaced(doubles, _SIMPLE))
    braces = "split(regexp_replace(s, '[^{}]', ''), '')"
    deeper = "a.now + CASE c WHEN '{' THEN 1 WHEN '}' THEN -1 ELSE 0 END"
    depth = (
        f"aggregate({braces}, named_struct('now', 0, 'most', 0), "
        f"(a, c) -> named_struct('now', {deeper}, 'most', greatest(a.most, {deeper})), a -> a.most)"
    )
    folded = f"transform(regexp_extract_all(t, r'{_INNERMOST}', 0), p -> {_folded_container('p')})"
    level = _let(folded, "f", f"array_join(transform(split(t, r'{_INNERMOST}'), (r, i) -> concat(r, coalesce(get(f, i), ''))), '')")
    step = _let(_replaced("t", _ENTRIES), "t", level)
    whole = f"aggregate(sequence(1, greatest(1, {depth})), s, (t, n) -> IF(instr(t, '{{') = 0, t, {step}))"
    back = f"translate(w, '{_IN_STRINGS}{''.join(_FOLDED.values())}', '{_STRUCTURE}{''.join(_FOLDED)}')"
    shown = rf"replace(replace({back}, '{_QUOTE}', r'\"'), '{_ESCAPED}', r'\\')"
    return _let(simple, "s", _let(whole, "w", f"IF(w RLIKE '[{{\\\\[]', NULL, {shown})"))


def decode_any_value(text: str) -> Column:
    """Plain JSON text, in a variant's notation, of a nested any-value's JSON (SQL text); NULL where there is none."""
    return F.expr(f"to_json(try_parse_json({_plain_json(text)}))")


def _deep_json(v: str) -> str:
    """Variant of a container that is not flat; NULL for anything else and where JSON has none."""
    return f"CASE WHEN {_is_container(v)} AND {_is_deep(v)} THEN try_parse_json({_plain_json(f'to_json({v})')}) END"


def any_as_string(v: str) -> Column:
    """Text of an any-value: scalars printed, containers as JSON, '' for an empty value;
    NULL stays NULL, so a missing attribute can be told from an empty one."""
    return F.expr(
        f"coalesce({_scalar_text(v)}, to_json({_flat_json(v)}), to_json({_deep_json(v)}), CASE WHEN {v} IS NOT NULL THEN '' END)"
    )


def body_value(v: str) -> Column:
    """JSON value of a record body.

    Text stays a JSON string even if it holds JSON; an empty or missing body is
    JSON null, not NULL; a body without a JSON form becomes ``{"raw": text}``.
    """
    d = f"{v}.doubleValue"
    # Scalars without a JSON form are the non-finite doubles and what is no 64-bit integer.
    text = f"""CASE WHEN isnan({d}) THEN 'NaN' WHEN {d} = double('inf') THEN '+Inf'
        WHEN {d} = double('-inf') THEN '-Inf' ELSE coalesce({v}.intValue, '') END"""
    fails = f"{_is_container(v)} OR {d} IS NOT NULL OR {v}.intValue IS NOT NULL"
    return F.coalesce(
        F.expr(f"coalesce({_scalar_json(v)}, {_flat_json(v)})"),
        F.expr(_deep_json(v)),
        F.expr(f"CASE WHEN {fails} THEN to_variant_object(named_struct('raw', {text})) ELSE parse_json('null') END"),
    )
