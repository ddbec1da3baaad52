"""Bulk updates as data: rows ``(key, field, op, value[, at][, condition])``, typed by the stored column they change.

``value`` is text or a variant: a number, JSON for arrays, maps and structs, plain text otherwise.  ``at`` names one map key, one array position
(from 0) or a dotted struct member, and the operation then applies to what stands there.  Nothing is computed through a wider or narrower type
than the field's own: whole numbers stay exact, and a result that does not fit is an error, not another number.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.functions import updates as up
from lodestone.operators.writes import Applied, _failed

ARITHMETIC = ("increment", "decrement", "multiply", "divide")
MODIFY = ("replace", "add", "multiply")

Case = tuple[Column, Column, Column]  # when it applies, whether its operand fits, the new value


def _number_cases(kind: T.DataType, old: Column, op: Column, text: Column) -> list[Case]:
    name = kind.simpleString()
    if isinstance(kind, T.IntegralType):
        wide, whole, real = old.cast("bigint"), text.try_cast("bigint"), text.try_cast("double")
        exact = (
            F.try_add(wide, whole), F.try_subtract(wide, whole), F.try_multiply(wide, whole),
            F.call_function("div", wide, F.nullif(whole, F.lit(0).cast("bigint"))),
        )
        rough = (old + real, old - real, old * real, F.try_divide(old, real))
        results = [F.when(whole.isNotNull(), e).otherwise(r.try_cast("bigint")).try_cast(name) for e, r in zip(exact, rough)]
        fits = real.isNotNull()
    else:
        n = text.try_cast(name if isinstance(kind, T.DecimalType) else "double")
        results = [x.try_cast(name) for x in (F.try_add(old, n), F.try_subtract(old, n), F.try_multiply(old, n), F.try_divide(old, n))]
        fits = n.isNotNull()
    return [(op == o, fits & (text.try_cast("double") != 0 if o == "divide" else F.lit(True)), r) for o, r in zip(ARITHMETIC, results)]


def _cells(text: Column, kind: T.DataType, keys: str) -> Column:
    """A JSON object as a map; its keys, which JSON has as text, in the field's type."""
    found = F.from_json(text, T.MapType(T.StringType(), kind))
    return found if keys == "string" else F.transform_keys(found, lambda k, _: k.try_cast(keys))


def _choose(cases: list[Case], at: int) -> Column:
    out = F
    for case in cases:
        out = out.when(case[0], case[at])
    return out.otherwise(F.lit(None))  # type: ignore[union-attr]


def _cases(kind: T.DataType, old: Column, op: Column, text: Column, at: Column) -> list[Case]:
    """What each operation does to a value of this type; ``at`` is null where the whole value is meant."""
    whole, nothing = at.isNull(), F.lit(None).cast("string")
    out: list[Case] = [(whole & (op == "clear"), F.lit(True), F.lit(None).cast(kind))]
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        parsed = _cells(text, kind.valueType, kind.keyType.simpleString()) if isinstance(kind, T.MapType) else F.from_json(text, kind)
    else:
        parsed = text if isinstance(kind, T.StringType) else text.try_cast(kind.simpleString())
    out.append((whole & (op == "assign"), parsed.isNotNull(), parsed))
    if isinstance(kind, T.NumericType):
        out += [(whole & g, ok, v) for g, ok, v in _number_cases(kind, old, op, text)]
    elif isinstance(kind, T.ArrayType):
        inner, place = kind.elementType, at.try_cast("int")
        out.append((whole & (op == "add"), parsed.isNotNull(), F.concat(F.coalesce(old, F.array().cast(kind)), parsed)))
        out.append((whole & (op == "remove"), parsed.isNotNull(), up.remove_elements(parsed)(old)))
        if isinstance(inner, T.NumericType):
            cells = _cells(text, inner, "int")
            for how in MODIFY:
                out.append((whole & (op == f"modify_{how}"), cells.isNotNull(), F.transform(old, _modified(how, cells, inner))))
        sub = lambda x: _cases(inner, x, op, text, nothing)
        changed = F.transform(old, lambda x, i: F.when(i == place, _choose(sub(x), 2)).otherwise(x))
        out.append((at.isNotNull(), place.isNotNull() & _choose(sub(F.lit(None).cast(inner)), 1), changed))
    elif isinstance(kind, T.MapType):
        key_kind, inner = kind.keyType.simpleString(), kind.valueType
        names = F.from_json(text, T.ArrayType(kind.keyType))
        out.append((whole & (op == "add"), parsed.isNotNull(), up.add_weights(parsed)(old)))
        out.append((whole & (op == "remove"), names.isNotNull(), up.remove_keys(names)(old)))
        if isinstance(inner, T.NumericType):
            for how in MODIFY:
                out.append((whole & (op == f"modify_{how}"), parsed.isNotNull(), F.transform_values(old, _flipped(_modified(how, parsed, inner)))))
        key = at.try_cast(key_kind)
        sub = lambda x: _cases(inner, x, op, text, nothing)
        none = F.lit(None).cast(inner)
        out.append((at.isNotNull() & (op == "remove"), key.isNotNull(), F.map_filter(old, lambda k, _: k != key)))
        # assigning to a key that is not there puts it there
        put = up.add_weights(F.create_map(key, _choose(sub(none), 2)))(old)
        out.append((at.isNotNull() & (op == "assign"), key.isNotNull() & _choose(sub(none), 1), put))
        out.append((at.isNotNull(), key.isNotNull() & _choose(sub(none), 1), F.transform_values(old, lambda k, x: F.when(k == key, _choose(sub(x), 2)).otherwise(x))))
    elif isinstance(kind, T.StructType):
        for path, inner in _members(kind):
            cur = old
            for p in path.split("."):
                cur = cur.getField(p)
            for g, ok, v in _cases(inner, cur, op, text, nothing):
                out.append(((at == path) & g, ok, old.withField(path, v)))
    return out


def _modified(how: str, cells: Column, kind: T.DataType) -> Callable[[Column, Column], Column]:
    """From a cell and its address to the new cell; cells that are not named stay."""

    def cell(x: Column, address: Column) -> Column:
        n = F.try_element_at(cells, address)
        new = {"replace": n, "add": x + n, "multiply": x * n}[how].cast(kind)
        return F.when(n.isNotNull(), new).otherwise(x)

    return cell


def _flipped(f: Callable[[Column, Column], Column]) -> Callable[[Column, Column], Column]:
    return lambda k, x: f(x, k)


def _members(kind: T.StructType) -> list[tuple[str, T.DataType]]:
    out = []
    for f in kind.fields:
        out.append((f.name, f.dataType))
        if isinstance(f.dataType, T.StructType):
            out += [(f"{f.name}.{p}", t) for p, t in _members(f.dataType)]
    return out


def _text(updates: DataFrame) -> Column:
    if updates.schema["value"].dataType.simpleString() == "variant":
        return F.coalesce(F.try_variant_get("value", "$", "string"), F.to_json("value"))
    return F.col("value").cast("string")


def bulk_update(
    base: DataFrame, updates: DataFrame, key: str, fields: list[str], *, create_if_missing: bool = False,
    conditions: Mapping[str, Column] | None = None,
) -> Applied:
    """Operations: ``assign``, ``clear``, ``increment``, ``decrement``, ``multiply``, ``divide``, ``add`` and ``remove`` (elements, weights, keys),
    ``modify_replace``, ``modify_add`` and ``modify_multiply`` (tensor cells), each on a whole field or ``at`` a part of it.

    ``conditions`` are named; the updates of a document apply only if all the conditions that its rows name hold for the stored
    document.  Rows of one document are folded into one by a conditional aggregate over the declared fields, so nothing is collected
    per key.  A document is changed by all of its rows or by none.  Every row that cannot be applied is an error of its own: an
    unknown field, operation or condition, or an operand that does not fit.  A field named twice for one document, a failed
    condition, a missing document and a result out of range are one error a document.
    """
    conditions = conditions or {}
    kinds = {f: base.schema[f].dataType for f in fields}
    blank = F.lit(None).cast("string")
    at = F.col("at").cast("string") if "at" in updates.columns else blank
    named = F.col("condition") if "condition" in updates.columns else blank
    rows = updates.select(key, "field", "op", _text(updates).alias("value"), at.alias("at"), named.alias("condition"))

    message = F.when(F.coalesce(~F.col("field").isin(fields), F.lit(True)), "unknown field")
    for f, kind in kinds.items():
        fits = _choose(_cases(kind, F.lit(None).cast(kind), F.col("op"), F.col("value"), F.col("at")), 1)
        here = F.col("field") == f
        message = message.when(here & fits.isNull(), F.concat(F.lit("unknown operation "), F.coalesce("op", F.lit("null"))))
        message = message.when(here & ~fits, F.concat(F.lit("operand of "), F.col("op"), F.lit(" does not fit")))
    unknown = F.col("condition").isNotNull() & ~F.coalesce(F.col("condition").isin(list(conditions)), F.lit(False))
    rows = rows.withColumn("_message", message.when(unknown, "unknown condition"))
    ident = F.col(key).cast("string").alias("id")
    errors = rows.where("_message IS NOT NULL").select(ident, F.col("_message").alias("message"), F.lit(400).alias("status"))

    slots = [F.count("_message").alias("_bad")]
    for i, f in enumerate(fields):
        here = F.col("field") == f
        slots += [F.max(F.when(here, F.struct("op", "value", "at"))).alias(f"_u{i}"), F.count_if(here).alias(f"_c{i}")]
    slots += [F.coalesce(F.bool_or(F.col("condition") == c), F.lit(False)).alias(f"_k{i}") for i, c in enumerate(conditions)]
    folded = rows.groupBy(key).agg(*slots)
    repeated = F.greatest(*[F.col(f"_c{i}") for i in range(len(fields))], F.lit(0)) > 1
    errors = errors.unionByName(
        folded.where((F.col("_bad") == 0) & repeated).select(ident, F.lit("one field updated twice in a batch").alias("message"), F.lit(400).alias("status"))
    )
    good = folded.where((F.col("_bad") == 0) & ~repeated).drop("_bad", *[f"_c{i}" for i in range(len(fields))])
    holds = F.lit(True)
    for i, c in enumerate(conditions.values()):
        holds = holds & (~F.col(f"_k{i}") | F.coalesce(c, F.lit(False)))

    def changed(table: DataFrame) -> DataFrame:
        """The new values beside the old ones, and whether one is out of range; in steps, so that no expression stands in another twice."""
        values = {}
        for i, f in enumerate(fields):
            u = F.col(f"_u{i}")
            values[f"_n{i}"] = F.when(u.isNull(), F.col(f"`{f}`")).otherwise(_choose(_cases(kinds[f], F.col(f"`{f}`"), u["op"], u["value"], u["at"]), 2))
        table = table.withColumns({**values, "_holds": holds})
        over = F.lit(False)
        for i, f in enumerate(fields):
            if isinstance(kinds[f], T.NumericType):
                over = over | (F.col(f"_u{i}.op").isin(*ARITHMETIC) & F.col(f"`{f}`").isNotNull() & F.col(f"_n{i}").isNull())
        return table.withColumn("_over", F.coalesce(over, F.lit(False)))

    def applied(table: DataFrame, ok: Column) -> DataFrame:
        ok = ok & ~F.col("_over")
        new = {f: F.when(ok, F.col(f"_n{i}")).otherwise(F.col(f"`{f}`")).alias(f) for i, f in enumerate(fields)}
        return changed(table).select(*[new.get(c, F.col(f"`{c}`")) for c in base.columns])

    found = good.withColumn("_hit", F.lit(True))
    state = applied(base.join(found, key, "left"), F.coalesce(F.col("_hit"), F.lit(False)) & F.col("_holds"))
    judged = changed(base.join(good, key)).select(key, F.col("_holds").alias("_ok"), "_over")
    seen = good.select(key).join(judged, key, "left")
    errors = errors.unionByName(_failed(seen.where("NOT _ok"), key, "condition not met"))
    errors = errors.unionByName(seen.where("_ok AND _over").select(ident, F.lit("result out of range").alias("message"), F.lit(400).alias("status")))
    absent = seen.where("_ok IS NULL").select(key)
    if not create_if_missing:
        return Applied(state, errors.unionByName(_failed(absent, key, "document does not exist")))
    empty = good.join(absent, key, "left_semi").withColumns({c: F.lit(None).cast(base.schema[c].dataType) for c in base.columns if c != key})
    return Applied(state.unionByName(applied(empty, F.lit(True))), errors)
