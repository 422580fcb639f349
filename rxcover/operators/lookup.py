"""Dose explorer: unique dose combinations with the product names that share
them, text search over that table, and paging.

``ddd_lookup`` groups on (ATC code, dose, unit, mg) and joins the distinct
names of each group. Names are made distinct per group first, which spreads a
hot group over tasks by name and combines copies map-side; only then are a
group's names collected. The final row is as wide as the group's names: that
is the feature. Everything else avoids it: a page picks its group keys before
any name is collected (``lookup_page``), a search tests names row by row and
collects only the groups that match (``lookup_search``), and
``ddd_lookup_names`` is the same table in long form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxcover import codes
from rxcover.operators.order import rows_after

LOOKUP_GROUP = ("atc_code", "ddd", "ddd_uom", "ddd_mg")


def present(df: DataFrame, wanted) -> list[str]:
    """The columns of ``wanted`` that ``df`` has, in order (optional columns
    are decided when the plan is built)."""
    return [c for c in wanted if c in df.columns]


def _with_dose(df: DataFrame) -> DataFrame:
    keep = present(df, ("vmp_nm",) + LOOKUP_GROUP)
    return df.select(*keep).filter(F.col("ddd").isNotNull())


def _name_ok(name: Column) -> Column:
    return name.isNotNull() & (F.length(name) > 0)


def _collected(slim: DataFrame) -> DataFrame:
    keys = present(slim, LOOKUP_GROUP)
    name = F.when(_name_ok(F.col("vmp_nm")), F.col("vmp_nm"))
    names = F.array_join(F.array_sort(F.collect_list("vmp_nm")), codes.NAME_SEPARATOR)
    return slim.select(*keys, name.alias("vmp_nm")).distinct().groupBy(*keys).agg(names.alias("drug_names"))


def _key_order(keys: list[str]) -> list[Column]:
    return [F.col(k).asc_nulls_last() for k in keys]


def ddd_lookup(df: DataFrame) -> DataFrame:
    """One row per dose combination present (null is a group value), with
    the distinct non-empty product names sorted and joined by ``" | "``
    (``""`` when there are none). Ordered by ATC code, nulls last."""
    slim = _with_dose(df)
    return _collected(slim).orderBy(*_key_order(present(slim, LOOKUP_GROUP)))


def _of_keys(slim: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``slim`` whose group is among ``wanted`` (null-safe)."""
    names = [f"_k{i}" for i in range(len(keys))]
    cond = None
    for k, n in zip(keys, names):
        c = slim[k].eqNullSafe(F.col(n))
        cond = c if cond is None else cond & c
    return slim.join(wanted.toDF(*names), cond, "left_semi")


def lookup_page(df: DataFrame, page_no: int = 1, size: int = codes.DDD_LOOKUP_PAGE_SIZE,
                after: tuple | None = None) -> DataFrame:
    """A page of ``ddd_lookup``: a top-k of the distinct group keys, then the
    names of those groups only. With ``after`` (the last key shown) it is the
    next page, at the cost of a first one; ``page_no`` skips by offset."""
    slim = _with_dose(df)
    keys = present(slim, LOOKUP_GROUP)
    groups = slim.select(*keys).distinct()
    if after is not None:
        groups = rows_after(groups, keys, after)
    wanted = page(groups, 1 if after is not None else page_no, size, _key_order(keys))
    return _collected(_of_keys(slim, wanted, keys)).orderBy(*_key_order(keys))


def _grams(text: Column) -> Column:
    """The distinct runs of three characters of a lower-cased text."""
    low = F.lower(text)
    return F.when(F.length(low) >= 3, F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.length(low) - 2), lambda i: F.substr(low, i, F.lit(3)))))


def lookup_index(df: DataFrame) -> DataFrame:
    """An inverted index of the lookup: distinct rows of a run of three
    characters (``gram``) and the key of a group that shows it in a cell or a
    name. In order of ``gram``, so that a stored index is read for the wanted
    runs only; a run that many groups show is many plain rows."""
    slim = _with_dose(df)
    keys = present(slim, LOOKUP_GROUP)
    types = dict(slim.dtypes)
    names = slim.select(*keys, "vmp_nm").distinct().select(*keys, _grams(F.col("vmp_nm")).alias("grams"))
    cells = slim.select(*keys).distinct()
    for k in keys:
        names = names.unionByName(cells.select(*keys, _grams(shown(k, types[k])).alias("grams")))
    rows = names.select(F.explode("grams").alias("gram"), *keys).distinct()
    return rows.repartitionByRange("gram", *keys).sortWithinPartitions("gram")


def _wanted_grams(term: str | None, column_terms: dict[str, str | tuple] | None) -> list[str]:
    """Runs of three characters that every match shows. A word is within one
    cell or name; so is a phrase of a column, but for the names' separator."""
    bar = codes.NAME_SEPARATOR.strip()
    texts = (term or "").split()
    texts += [t.strip() for t in (column_terms or {}).values() if isinstance(t, str) and bar not in t]
    lows = [t.lower() for t in texts]
    return sorted({t[i:i + 3] for t in lows for i in range(len(t) - 2)})


def lookup_search(df: DataFrame, term: str | None = None, column_terms: dict[str, str | tuple] | None = None,
                  index: DataFrame | None = None) -> DataFrame:
    """``ddd_search(ddd_lookup(df), ...)`` without collecting the names of
    groups that do not match: every word is tested on the group's cells and,
    row by row, on its names. With an ``index`` (:func:`lookup_index`) only
    groups that show all of the search's runs of three characters are tested;
    a search without any reads all."""
    slim = _with_dose(df)
    keys = present(slim, LOOKUP_GROUP)
    types = dict(slim.dtypes)
    grams = _wanted_grams(term, column_terms) if index is not None else []
    if grams:
        found = index.where(F.col("gram").isin(grams)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        slim = _of_keys(slim, found.where(F.col("n") == len(grams)).select(*keys), keys)
    name = F.when(_name_ok(F.col("vmp_nm")), F.lower("vmp_nm"))

    def in_names(w: str) -> Column:
        # no word holds a space, so across names it can only be the bar
        hit = F.coalesce(F.bool_or(name.contains(w)), F.lit(False))
        return hit | (F.min(name) < F.max(name)) if w == codes.NAME_SEPARATOR.strip() else hit

    words = [w.lower() for w in (term or "").split()]
    cells = {c: t for c, t in (column_terms or {}).items() if c != "drug_names"}
    flags = [in_names(w).alias(f"_w{i}") for i, w in enumerate(words)]
    whole = (column_terms or {}).get("drug_names")
    groups = slim.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *flags)
    for i, w in enumerate(words):
        hit = F.col(f"_w{i}")
        for c in keys:
            hit = hit | _cell_has(c, types[c], w)
        groups = groups.filter(hit)
    for c, t in cells.items():
        groups = groups.filter(_column_test(c, types[c], t))
    out = _collected(_of_keys(slim, groups.select(*keys), keys))
    if whole is not None:  # a phrase may run across names
        out = out.filter(_column_test("drug_names", "string", whole))
    return out


def ddd_lookup_names(df: DataFrame) -> DataFrame:
    """Long form of the lookup: distinct (group, name) rows."""
    slim = _with_dose(df)
    keys = present(slim, LOOKUP_GROUP)
    return slim.filter(_name_ok(F.col("vmp_nm"))).select(*keys, F.col("vmp_nm").alias("drug_name")).distinct()


def shown(c: str, dtype: str) -> Column:
    """A cell as the table shows it: numbers as plain decimals without
    trailing zeros or exponent, at any magnitude (``1500.0`` shows as
    ``1500``, ``5.0E-4`` as ``0.0005``, ``1.0E21`` with 21 zeros), other
    values as text."""
    x = F.col(c)
    if dtype not in ("double", "float"):
        return x.cast("string")
    text = (x + F.lit(0).cast(dtype)).cast("string")             # no negative zero
    sign = F.when(F.startswith(text, F.lit("-")), "-").otherwise("")
    mantissa = F.ltrim(F.substring_index(text, "E", 1), F.lit("-"))
    exponent = F.substring_index(text, "E", -1).try_cast("int")
    digits = F.rtrim(F.replace(mantissa, F.lit("."), F.lit("")), F.lit("0"))
    large = F.rpad(digits, F.greatest(F.length(digits), exponent + 1), F.lit("0"))
    plain = (F.when(exponent < 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), digits))
             .otherwise(F.rtrim(F.concat(F.left(large, exponent + 1), F.lit("."), F.substr(large, exponent + 2)), F.lit("."))))
    return (F.when(F.contains(text, F.lit("E")), F.concat(sign, plain))
            .when(F.contains(text, F.lit(".")), F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))).otherwise(text))


def _cell_has(c: str, dtype: str, word: str) -> Column:
    return F.coalesce(F.lower(shown(c, dtype)).contains(word), F.lit(False))


def _column_test(c: str, dtype: str, wanted: str | tuple) -> Column:
    """Text: the shown cell contains it, ignoring case. A pair: the number
    lies in the range, both ends included (None: open)."""
    if isinstance(wanted, str):
        return _cell_has(c, dtype, wanted.lower())
    lo, hi = wanted
    cond = F.col(c).isNotNull()
    if lo is not None:
        cond = cond & (F.col(c) >= F.lit(lo))
    return cond if hi is None else cond & (F.col(c) <= F.lit(hi))


def ddd_search(lookup: DataFrame, term: str | None = None,
               column_terms: dict[str, str | tuple] | None = None) -> DataFrame:
    """Rows of a table matching a search.

    ``term`` is split on whitespace and every word must occur, ignoring
    case, in at least one cell of the row as shown. ``column_terms`` adds
    per-column filters: a text the shown cell must contain, ignoring case,
    or for a numeric column a range ``(low, high)``.
    """
    types = dict(lookup.dtypes)
    out = lookup
    for word in (term or "").split():
        hit = None
        for c in lookup.columns:
            h = _cell_has(c, types[c], word.lower())
            hit = h if hit is None else (hit | h)
        out = out.filter(hit)
    for c, t in (column_terms or {}).items():
        out = out.filter(_column_test(c, types[c], t))
    return out


def page(df: DataFrame, page_no: int = 1, size: int = codes.DDD_LOOKUP_PAGE_SIZE,
         order: list[Column] | None = None) -> DataFrame:
    """Page ``page_no`` (1-based) of ``size`` rows in the given total order.
    Planned as a top-k (``TakeOrderedAndProject``) of ``page_no * size``
    rows; for deep pages of a large table, filter with
    :func:`rxcover.operators.order.rows_after` and take page 1."""
    ordered = df.orderBy(*order) if order else df
    return ordered.offset((page_no - 1) * size).limit(size)


def display(df: DataFrame, headers: dict[str, str]) -> DataFrame:
    """Rename columns to their display headers (columns not listed keep
    their name)."""
    return df.toDF(*[headers.get(c, c) for c in df.columns])
