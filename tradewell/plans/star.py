"""The star under a filter context: which dimensions a question needs, and two ways to aggregate it."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewell.functions.money import net_amount

# Key of each dimension that joins the fact itself, and the fact's column for it.
# The date dimension has three roles; only the order date is active unless asked otherwise.
DIRECT = {"DimCustomers": "CustomerKey", "DimEmployees": "EmployeeKey", "DimShippers": "ShipperKey",
          "DimProducts": "ProductKey", "DimDate": "DateKey"}
# Dimensions reached through the product.
THROUGH_PRODUCT = {"DimCategories": "CategoryKey", "DimSuppliers": "SupplierKey"}
DATE_ROLES = {"order": "OrderDateKey", "shipped": "ShippedDateKey", "required": "RequiredDateKey"}
# Columns that the stored fact is partitioned by, under the calendar attribute that they repeat.
PERIODS = {"DimDate.Year": "OrderYear", "DimDate.Month": "OrderMonth"}

Condition = Sequence | Callable[[Column], Column]
# A key of the fact to count once, and the lines on which it counts.
Counted = tuple[str, Column | None]


def split_ref(ref: str) -> tuple[str, str]:
    table, column = ref.split(".")
    return table, column


def _slot(ref: str) -> str:
    """Column name of a dimension attribute inside a joined frame."""
    return ref.replace(".", "__")


def _holds(column: Column, condition: Condition) -> Column:
    return condition(column) if callable(condition) else column.isin(list(condition))


def _when(condition: Column | None, value: Column) -> Column:
    return value if condition is None else F.when(condition, value)


def net() -> Column:
    """Amount of a line before cents rounding; what total sales sums."""
    return net_amount(F.col("Quantity"), F.col("UnitPrice"), F.col("Discount"))


@dataclass(frozen=True)
class Ask:
    """One grouping among several that share a read of the fact.

    ``by`` holds columns of one dimension (products, categories and suppliers count as one) or one of the
    fact, at most one number and two texts, which become ``number``, ``name`` and ``within``.
    Filters on ``without`` (columns or tables) do not count. With a ``key``, lines are first brought
    together by that key. ``members`` lists members without lines too: those of the "context", or "all"
    with the filters in ``without`` removed.
    """

    by: tuple[str, ...] = ()
    without: tuple[str, ...] = ()
    key: str | None = None
    members: str = ""

    def counts(self, ref: str) -> bool:
        """Whether the filter on a column applies to this grouping."""
        return ref not in self.without and split_ref(ref)[0] not in self.without


@dataclass(frozen=True)
class Star:
    """Gold tables plus filters. Filters map ``Table.Column`` to a list of values or a predicate."""

    tables: Mapping[str, DataFrame]
    filters: Mapping[str, Condition] = field(default_factory=dict)
    date_role: str = "order"

    def filtered(self, filters: Mapping[str, Condition]) -> Star:
        return replace(self, filters={**self.filters, **filters})

    def without(self, *targets: str) -> Star:
        """drop the filters on columns (``Table.Column``) or on whole tables (``Table``)."""
        return replace(self, filters={r: c for r, c in self.filters.items() if Ask(without=targets).counts(r)})

    def dimension(self, name: str) -> DataFrame:
        """Rows of a table under its own filters. Filters flow from the one side of a relationship to
        the many side: those on categories and suppliers reach products, none on the fact reach back.
        """
        df = self.tables[name]
        for ref, condition in self.filters.items():
            table, column = split_ref(ref)
            if table == name:
                df = df.where(_holds(F.col(column), condition))
        if name == "DimProducts":
            for far in dict.fromkeys(split_ref(r)[0] for r in self.filters):
                if far in THROUGH_PRODUCT:
                    key = THROUGH_PRODUCT[far]
                    df = df.join(self.dimension(far).select(key), key, "left_semi")
        return df

    def members(self, ref: str) -> DataFrame:
        """Distinct values of one column in the context, as a one-column frame."""
        table, column = split_ref(ref)
        return self.dimension(table).select(column).distinct()

    # ---- rows of the fact -----------------------------------------------------------------------

    def _own(self, ref: str) -> str | None:
        """The fact's own column that says the same as a reference, if it has one."""
        table, column = split_ref(ref)
        if table == "Sales":
            return column
        if ref == "DimDate.DateKey":
            return DATE_ROLES[self.date_role]
        if ref == "DimDate.FullDate":
            return DATE_ROLES[self.date_role].removesuffix("Key")
        period = PERIODS.get(ref) if self.date_role == "order" else None
        return period if period in self.tables["Sales"].columns else None

    def rows(self, refs: Iterable[str], unapplied: Iterable[str] = ()) -> DataFrame:
        """Fact rows under the filters, with a column for each reference; filters on ``unapplied`` do not count.

        Filters on attributes that the fact holds itself come first: those on the year (and month) choose
        partitions, those on days meet row groups sorted by day. Then lists of values on a dimension
        reduce the fact to the keys that hold them, before anything is grouped. All other attributes
        are looked up. Spark broadcasts a side that is small by its own measure; else it sorts both, and
        adaptive execution splits a hot key. A line without a dimension row keeps null attributes.
        """
        unapplied = set(unapplied)
        filters = {r: c for r, c in self.filters.items() if r not in unapplied}
        refs = list(dict.fromkeys([*refs, *unapplied]))
        rows = self.tables["Sales"]
        for ref, condition in filters.items():
            if own := self._own(ref):
                rows = rows.where(_holds(F.col(own), condition))
                years = _years(ref, condition)
                if years is not None and (period := self._own("DimDate.Year")):
                    rows = rows.where(F.col(period).isin(years))
        listed = {r: c for r, c in filters.items() if not self._own(r) and not callable(c)}
        for table in dict.fromkeys("DimProducts" if t in THROUGH_PRODUCT else t for t, _ in map(split_ref, listed)):
            keys = replace(self, filters=listed).dimension(table).select(F.col(DIRECT[table]).alias("_held"))
            rows = rows.join(keys, F.col(self._fact_key(table)) == F.col("_held"), "left_semi")
        tested = {r: c for r, c in filters.items() if not self._own(r) and callable(c)}
        rows = self._looked_up(rows, dict.fromkeys([r for r in refs if not self._own(r)] + list(tested)))
        for ref, condition in tested.items():
            rows = rows.where(_holds(F.col(_slot(ref)), condition))
        return rows.withColumns({_slot(r): F.col(self._own(r)) for r in refs if self._own(r)})

    def _fact_key(self, table: str) -> str:
        return DATE_ROLES[self.date_role] if table == "DimDate" else DIRECT[table]

    def _looked_up(self, rows: DataFrame, refs: Iterable[str]) -> DataFrame:
        """Left joins, products before what is reached through them."""
        wanted: dict[str, list[str]] = {}
        for ref in refs:
            wanted.setdefault(split_ref(ref)[0], []).append(ref)
        far = [t for t in wanted if t in THROUGH_PRODUCT]
        near = list(dict.fromkeys([*[t for t in wanted if t in DIRECT], *(["DimProducts"] if far else [])]))
        for table in [*near, *far]:
            key = DIRECT.get(table) or THROUGH_PRODUCT[table]
            links = [THROUGH_PRODUCT[t] for t in far] if table == "DimProducts" else []
            dim = self.tables[table].select(
                F.col(key).alias(f"_{table}_key"), *[F.col(c).alias(f"_product_{c}") for c in links],
                *[F.col(split_ref(r)[1]).alias(_slot(r)) for r in wanted.get(table, [])])
            left = f"_product_{key}" if table in far else self._fact_key(table)
            rows = rows.join(dim, F.col(left) == F.col(f"_{table}_key"), "left")
        return rows

    # ---- aggregates -----------------------------------------------------------------------------

    def summarise(self, by: Mapping[str, str] | Iterable[str] = (), sums: Mapping[str, Column] | None = None,
                  distinct: Mapping[str, Counted] | None = None,
                  maxes: Mapping[str, Column] | None = None) -> DataFrame:
        """Group the fact by dimension attributes; sums, maxima and counts of distinct keys.

        Counts of one key are two plain aggregates: lines are brought together by the key, where each
        condition is a flag, and flags are counted.
        """
        by = by if isinstance(by, Mapping) else {split_ref(r)[1]: r for r in by}
        sums, distinct, maxes = dict(sums or {}), dict(distinct or {}), dict(maxes or {})
        keys = list(dict.fromkeys(k for k, _ in distinct.values()))
        rows = self.rows(by.values()).select(
            *[F.col(_slot(r)).alias(a) for a, r in by.items()], *[c.alias(n) for n, c in {**sums, **maxes}.items()],
            *[F.col(k).alias(f"_key_{k}") for k in keys], *[_when(c, F.col(k)).alias(n) for n, (k, c) in distinct.items()])
        plain = [*[F.sum(n).alias(n) for n in sums], *[F.max(n).alias(n) for n in maxes]]
        if len(keys) == 1:
            flags = [F.max(F.when(F.col(n).isNotNull(), 1)).alias(n) for n in distinct]
            rows = rows.groupBy(*by, f"_key_{keys[0]}").agg(*plain, *flags)
            return rows.groupBy(*by).agg(*plain, *[F.count(n).alias(n) for n in distinct])
        return rows.groupBy(*by).agg(*plain, *[F.count_distinct(n).alias(n) for n in distinct])

    def groups(self, asks: Mapping[str, Ask], sums: Mapping[str, Column], flags: Mapping[str, Column] | None = None) -> DataFrame:
        """Several groupings from one read of the fact.

        One row for each group: ``of`` (name of the ask), ``number``, ``name``, ``within``, ``member``
        (whether a dimension lists it) and the sums. For asks with a key also the number of ``keys``, and for
        each flag the sum over keys of its maximum and, as ``<flag>_keys``, on how many keys there is one.

        Lines first meet by the fact's own keys: each yields one small row for each key that some asks
        group by, and these meet in the tasks that read them. So asks about one dimension share a row,
        and attributes are looked up for keys, not for lines.
        """
        flags = dict(flags or {})
        ignored = {r for r in self.filters if not all(a.counts(r) for a in asks.values())}
        open_ = [r for r in self.filters if r in ignored and any(a.counts(r) for a in asks.values())]
        rows = replace(self, filters={r: c for r, c in self.filters.items() if r not in ignored or r in open_}).rows((), open_)
        types = {t: dict(self.tables[t].dtypes) for t in {"Sales", *(split_ref(r)[0] for a in asks.values() for r in a.by)}}
        key_types = {types["Sales"][a.key] for a in asks.values() if a.key}
        key_type = key_types.pop() if len(key_types) == 1 else "string"
        ids: dict[tuple, int] = {}
        places = {of: ids.setdefault((self._carrier(of, a), a.key, tuple(r for r in open_ if a.counts(r))), len(ids)) for of, a in asks.items()}
        entries = []
        for (carrier, key, counted), i in ids.items():
            entry = _entry(i, carrier or key, types["Sales"], F.col(key).cast(key_type) if key else F.lit(None).cast(key_type))
            for ref in counted:
                entry = F.when(_holds(F.col(_slot(ref)), self.filters[ref]), entry)
            entries.append(entry)
        held = F.array_compact(F.array(*entries)) if open_ else F.array(*entries)
        lines = rows.select(F.explode(held).alias("e"), *[c.alias(n) for n, c in {**sums, **flags}.items()])
        met = lines.groupBy("e").agg(F.count(F.lit(1)).alias("_lines"), *[F.sum(n).alias(n) for n in sums], *[F.max(n).alias(n) for n in flags])

        # From keys to labels.
        looked_up = list(dict.fromkeys(r for a in asks.values() for r in a.by if not self._own(r)))
        keys = {c: [i for (carrier, _, _), i in ids.items() if carrier == c] for c in {self._fact_key_of(r) for r in looked_up}}
        met = met.withColumns({c: F.when(F.col("e.id").isin(i), F.col("e.number")) for c, i in keys.items()})
        met = self._looked_up(met, looked_up)
        labels = []
        for of, ask in asks.items():
            own = F.col("e.number") if ask.by and _is_number(types["Sales"][self._carrier(of, ask)]) else F.col("e.text")
            label = _label(of, ask, {r: own if self._own(r) else F.col(_slot(r)) for r in ask.by}, types)
            labels.append(F.when(F.col("e.id") == places[of], label))
        found = met.select(F.explode(F.array_compact(F.array(*labels))).alias("g"), F.col("e.key").alias("key"), F.lit(None).cast("int").alias("member"),
                           *sums, *flags)
        schema = found.schema
        for of, ask in asks.items():
            if ask.members:
                there = (self if ask.members == "context" else self.without(*ask.without)).members(ask.by[0])
                label = _label(of, ask, {ask.by[0]: F.col(there.columns[0])}, types)
                found = found.union(there.select(label, F.lit(None).cast(key_type), F.lit(1), *[F.lit(None).cast(schema[n].dataType) for n in (*sums, *flags)]))
        found = found.select("g.*", "key", "member", *sums, *flags)
        group, plain = ["of", "number", "name", "within"], [F.max("member").alias("member"), *[F.sum(n).alias(n) for n in sums]]
        if any(a.key and not all(self._own(r) for r in a.by) for a in asks.values()):  # a key may have come with several keys of one label
            found = found.groupBy(*group, "key").agg(*plain, *[F.max(n).alias(n) for n in flags])
        if any(a.key for a in asks.values()):
            plain += [F.count("key").alias("keys"), *[F.sum(n).alias(n) for n in flags], *[F.count(n).alias(f"{n}_keys") for n in flags]]
        return found.groupBy(*group).agg(*plain)

    def _fact_key_of(self, ref: str) -> str:
        table = split_ref(ref)[0]
        return self._fact_key("DimProducts" if table in THROUGH_PRODUCT else table)

    def _carrier(self, of: str, ask: Ask) -> str | None:
        """The one column of the fact that decides an ask's labels."""
        carriers = {self._own(r) or self._fact_key_of(r) for r in ask.by}
        if len(carriers) > 1:
            raise ValueError(f"{of}: its columns must belong to one key of the fact")
        return carriers.pop() if carriers else None


def _is_number(kind: str) -> bool:
    return kind in ("int", "bigint", "smallint", "tinyint")


def _entry(i: int, column: str | None, types: Mapping[str, str], key: Column) -> Column:
    number = F.col(column).cast("bigint") if column and _is_number(types[column]) else F.lit(None).cast("bigint")
    text = F.col(column).cast("string") if column and not _is_number(types[column]) else F.lit(None).cast("string")
    return F.struct(F.lit(i).alias("id"), number.alias("number"), text.alias("text"), key.alias("key"))


def _label(of: str, ask: Ask, values: Mapping[str, Column], types: Mapping[str, Mapping[str, str]]) -> Column:
    kinds = {r: _is_number(types[split_ref(r)[0]][split_ref(r)[1]]) for r in ask.by}
    numbers = [values[r].cast("bigint") for r in ask.by if kinds[r]]
    texts = [values[r].cast("string") for r in ask.by if not kinds[r]]
    if len(numbers) > 1 or len(texts) > 2:
        raise ValueError(f"{of}: at most one number and two texts")
    none, text = F.lit(None).cast("bigint"), F.lit(None).cast("string")
    return F.struct(F.lit(of).alias("of"), (numbers + [none])[0].alias("number"), (texts + [text])[0].alias("name"),
                    ([*texts, text, text])[1].alias("within"))


def _years(ref: str, condition: Condition) -> list[int] | None:
    """The years of a list of days."""
    if ref != "DimDate.FullDate" or callable(condition) or not all(isinstance(d, datetime.date) for d in condition):
        return None
    return sorted({d.year for d in condition})
