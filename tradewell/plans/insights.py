"""Text answers and cards: the numbers and winners behind each sentence, and the sentence itself.

Every answer is one row. It says which groupings of the fact it needs, which numbers it takes from their
rows, and what it shows. A page puts the needs of its answers together, so it reads the fact once.
Groups that feed a winner are bounded by the calendar, the category bucket or a dimension, and only
their best row leaves the aggregate.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewell.functions.text import dollars, fill, fixed, percent, whole
from tradewell.operators.ranking import winner_or_blank, winner_smallest_label
from tradewell.plans import measures as m
from tradewell.plans.star import Ask, Star, net

# The sentences of the answers, with places for their numbers and winners.
SENTENCES = {
    "growth": "Sales grew {before} into {year}, then {after} the year after. Prioritize retention for customers acquired in {year} to protect against the post-peak drop.",
    "growth_fell": "fell {change}",
    "growth_rose": "kept rising {change}",
    "operations": "Average delivery is {days} days at a {rate} on-time rate. {shipper} runs slowest — renegotiate their SLA or shift volume to a faster carrier.",
    "buying": "{customer} drives {share} of total revenue. {advice}",
    "buying_risk": "That's a retention risk — build a dedicated account plan and diversify acquisition.",
    "buying_ok": "Revenue is healthily diversified — keep prioritizing broad acquisition.",
    "selling": "{top} leads sales; {bottom} lags furthest behind. Bundle {bottom} with {top} in promotions, or reassess whether it's worth the catalog space.",
    "glance": "Overall performance is {change} year-over-year. {advice}",
    "glance_up": "up {change}",
    "glance_down": "down {change}",
    "glance_up_advice": "Double down on this year's top category and channel.",
    "glance_down_advice": "Investigate what drove the decline before setting next quarter's budget.",
    "season": "{month} is consistently your strongest sales month.",
    "season_advice": "Build up inventory and staffing ahead of {month}, and test a promotion in your weakest month to smooth the seasonal gap.",
    "stock": "{count} product(s) are currently below their reorder level.",
    "stock_reorder": "Reorder now to avoid stockouts — check DimProducts for the exact list.",
    "stock_ok": "All products are stocked above threshold — no action needed.",
    "glance_total": "In {year}, {company} generated ${sales} in revenue across {orders} orders.",
    "year_selected": "Selected year ({year}) generated ${sales} in sales.",
    "year_peak": "Peak year: {year} with ${sales} in sales.",
    "leaders": "Leading category: {category}. Top product: {product}.",
    "top_customer": "Top customer: {customer} within the current filter selection.",
    "delivery": "On-time delivery: {rate}. Top performer: {employee}.",
}
ALL_YEARS = "All Years"
RISK_SHARE = 0.1

YEAR, MONTH = "DimDate.Year", "DimDate.MonthName"
CATEGORY, CUSTOMER = "DimCategories.CategoryName", "DimCustomers.CompanyName"

# The groupings that answers share, by name.
ASKS = {
    "total": Ask(),
    "years": Ask((YEAR,), without=(YEAR,), members="context"),
    "year": Ask((YEAR,)),
    "month": Ask((MONTH,), members="context"),
    "category": Ask((CATEGORY,), members="context"),
    "product": Ask(("DimProducts.ProductName",)),
    "customer": Ask((CUSTOMER,)),
    "shipper": Ask(("DimShippers.CompanyName",), members="context"),
    "employee": Ask(("DimEmployees.EmployeeKey", "DimEmployees.FullName")),
    "country": Ask(("Sales.ShipCountry",), key="OrderID"),
    "orders": Ask(key="OrderID"),
    "customers": Ask(key="CustomerKey"),
    "customers_of_year": Ask((YEAR,), key="CustomerKey", members="context"),
}
SUMS = {"lt": lambda: F.col("LineTotal"), "sales": net, "quantity": lambda: F.col("Quantity"),
        **{n: m.SUMS[n] for n in ("delivery_days", "delivery_lines", "on_time_lines", "flagged_lines")}}
FLAGS = {"on_time": lambda: F.when(F.col("OnTimeFlag") == 1, 1), "dated": lambda: F.when(m.dated(), 1)}

Get = Callable[[str], Column]


@dataclass(frozen=True)
class Answer:
    """What one answer needs and shows.

    ``numbers`` are aggregates over the rows of ``Star.groups``; ``shown`` makes the columns of the answer
    from them and gets each by its name.
    """

    asks: tuple[str, ...]
    needs: tuple[str, ...]
    numbers: Callable[[], Mapping[str, Column]]
    shown: Callable[[Star, Get], Mapping[str, Column]]
    flags: tuple[str, ...] = ()


def _row(star: Star, answers: Mapping[str, Answer]) -> DataFrame:
    """One row with the numbers of several answers, each under ``<answer>__<number>``."""
    asks, needs, flags = (dict.fromkeys(n for a in answers.values() for n in getattr(a, part)) for part in ("asks", "needs", "flags"))
    groups = star.groups({n: ASKS[n] for n in asks}, {n: SUMS[n]() for n in needs}, {n: FLAGS[n]() for n in flags})
    return groups.agg(*[c.alias(f"{name}__{n}") for name, a in answers.items() for n, c in a.numbers().items()])


def _get(name: str) -> Get:
    return lambda number: F.col(f"{name}__{number}")


def reply(answer: Answer, star: Star) -> DataFrame:
    """One answer, from one read of the fact."""
    return _row(star, {"a": answer}).select(*[c.alias(n) for n, c in answer.shown(star, _get("a")).items()])


def page(star: Star, answers: Mapping[str, Answer], entry: Callable[[str, Mapping[str, Column]], list[Column]]) -> DataFrame:
    """One row for each answer, all from one read of the fact; ``entry`` says what is shown of each."""
    entries = [F.struct(*entry(name, answer.shown(star, _get(name)))) for name, answer in answers.items()]
    return _row(star, answers).select(F.inline(F.array(*entries)))


def _of(ask: str, member: bool = False) -> Column:
    return (F.col("of") == ask) & (F.col("member") == 1) if member else F.col("of") == ask


def _value(ask: str, name: str) -> Column:
    """A sum over the rows of one grouping."""
    return F.sum(F.when(_of(ask), F.col(name)))


def _double(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("double")


def _growth(now: Column, before: Column) -> Column:
    """Relative change; a missing side counts as 0 above the line and as blank below it."""
    return F.try_divide(F.coalesce(now, F.lit(0.0)) - F.coalesce(before, F.lit(0.0)), before)


def _by_year() -> Column:
    """Line totals by year: as many entries as the calendar has years."""
    return F.map_from_entries(F.collect_list(F.when(
        _of("years") & F.col("number").isNotNull(), F.struct("number", _double("lt").alias("lt")))))


def _growth_shown(star: Star, get: Get) -> dict[str, Column]:
    year, by_year = get("peak"), get("by_year")
    at = {d: F.try_element_at(by_year, year + d) for d in (-1, 0, 1)}
    before, change = _growth(at[0], at[-1]), _growth(at[1], at[0])
    after = F.when(change < 0, fill(SENTENCES["growth_fell"], change=percent(F.abs(change)))).otherwise(
        fill(SENTENCES["growth_rose"], change=percent(change)))
    text = fill(SENTENCES["growth"], before=percent(before), year=year, after=after)
    return {"peak_year": year.cast("int"), "peak_sales": at[0], "growth_before": before, "change_after": change, "answer": text}


# The peak year in the context against its neighbours, which the year filter does not hide.
GROWTH_RECOMMENDATION = Answer(
    ("years",), ("lt",), lambda: {"peak": winner_or_blank("lt", "number", where=_of("years", member=True)), "by_year": _by_year()},
    _growth_shown)


def _operations_shown(star: Star, get: Get) -> dict[str, Column]:
    average, share = m.ratio(_double(get("days")), _double(get("lines"))), m.ratio(_double(get("on_time")), _double(get("flagged")))
    days = F.when(average.isNotNull(), fixed(average, 1))
    return {"avg_delivery_days": average, "on_time_share": share, "slowest_shipper": get("slowest"),
            "answer": fill(SENTENCES["operations"], days=days, rate=percent(share), shipper=get("slowest"))}


# Delivery averages per line and the slowest shipper.
OPERATIONS_RECOMMENDATION = Answer(
    ("shipper", "total"), ("delivery_days", "delivery_lines", "on_time_lines", "flagged_lines"),
    lambda: {"slowest": winner_or_blank(m.ratio("delivery_days", "delivery_lines"), "name", where=_of("shipper", member=True)),
             "days": _value("total", "delivery_days"), "lines": _value("total", "delivery_lines"),
             "on_time": _value("total", "on_time_lines"), "flagged": _value("total", "flagged_lines")},
    _operations_shown)


def _buying_shown(star: Star, get: Get) -> dict[str, Column]:
    share = F.when(get("top").isNotNull(), m.ratio(_double(get("best")), _double(get("total"))))
    advice = F.when(share > RISK_SHARE, SENTENCES["buying_risk"]).otherwise(SENTENCES["buying_ok"])
    return {"top_customer": get("top"), "concentration": share,
            "answer": fill(SENTENCES["buying"], customer=get("top"), share=percent(share, 1), advice=advice)}


# Best customer by name and the share of revenue on them.
BUYING_RECOMMENDATION = Answer(
    ("customer",), ("lt",),
    lambda: {"top": winner_or_blank("lt", "name", where=_of("customer")), "best": F.max(F.when(_of("customer"), F.col("lt"))),
             "total": _value("customer", "lt")},
    _buying_shown)

# Best and worst category.
SELLING_RECOMMENDATION = Answer(
    ("category",), ("lt",),
    lambda: {"top": winner_or_blank("lt", "name", where=_of("category", member=True)),
             "bottom": winner_or_blank("lt", "name", largest=False, where=_of("category", member=True))},
    lambda star, get: {"top_category": get("top"), "bottom_category": get("bottom"),
                       "answer": fill(SENTENCES["selling"], top=get("top"), bottom=get("bottom"))})


def _glance_shown(star: Star, get: Get) -> dict[str, Column]:
    last = star.dimension("DimDate").agg(F.max("Year")).scalar()
    yoy = _growth(F.try_element_at(get("by_year"), last.cast("bigint")), F.try_element_at(get("by_year"), last.cast("bigint") - 1))
    up = F.coalesce(yoy, F.lit(0.0)) >= 0
    change = F.when(up, fill(SENTENCES["glance_up"], change=percent(yoy))).otherwise(
        fill(SENTENCES["glance_down"], change=percent(F.abs(yoy))))
    advice = F.when(up, SENTENCES["glance_up_advice"]).otherwise(SENTENCES["glance_down_advice"])
    return {"last_year": last, "yoy": yoy, "answer": fill(SENTENCES["glance"], change=change, advice=advice)}


# Last calendar year of the context against the year before.
GLANCE_RECOMMENDATION = Answer(("years",), ("lt",), lambda: {"by_year": _by_year()}, _glance_shown)


def _season(sentence: str) -> Answer:
    return Answer(("month",), ("lt",), lambda: {"peak": winner_or_blank("lt", "name", where=_of("month", member=True))},
                  lambda star, get: {"peak_month": get("peak"), "answer": fill(SENTENCES[sentence], month=get("peak"))})


SEASONALITY_INSIGHT = _season("season")  # M29
SEASONALITY_RECOMMENDATION = _season("season_advice")  # M30


def _one_year(star: Star) -> Column:
    """The only year of the context, else null."""
    return star.members(YEAR).agg(F.when(F.count("*") == 1, F.max("Year"))).scalar()


def _growth_insight_shown(star: Star, get: Get) -> dict[str, Column]:
    selected, best = _one_year(star), get("best")
    sales = (-best["value"]).cast("double")
    text = F.when(selected.isNotNull(), fill(SENTENCES["year_selected"], year=selected, sales=whole(sales))).otherwise(
        fill(SENTENCES["year_peak"], year=best["label"], sales=whole(sales)))
    return {"selected_year": selected, "best_year": best["label"].cast("int"), "best_sales": sales, "answer": text}


# Sales of the selected year, else of the best one.
GROWTH_INSIGHT = Answer(("year",), ("sales",), lambda: {"best": winner_smallest_label("sales", "number", where=_of("year"))},
                        _growth_insight_shown)


# The members with the highest sales, ties broken by name.
SELLING_INSIGHT = Answer(
    ("category", "product"), ("sales",),
    lambda: {"category": winner_smallest_label("sales", "name", where=_of("category") & F.col("sales").isNotNull()),
             "product": winner_smallest_label("sales", "name", where=_of("product"))},
    lambda star, get: {"top_category": get("category")["label"], "top_product": get("product")["label"],
                       "answer": fill(SENTENCES["leaders"], category=get("category")["label"], product=get("product")["label"])})

# M53.
BUYING_INSIGHT = Answer(
    ("customer",), ("sales",), lambda: {"top": winner_smallest_label("sales", "name", where=_of("customer"))},
    lambda star, get: {"top_customer": get("top")["label"], "answer": fill(SENTENCES["top_customer"], customer=get("top")["label"])})


def _delivery_shown(star: Star, get: Get) -> dict[str, Column]:
    rate = F.coalesce(m.ratio(_double(get("on_time")), _double(get("dated"))), F.lit(0.0))
    best = F.coalesce(get("best")["label"]["name"], F.lit(""))
    return {"on_time_rate": rate, "top_employee": best,
            "answer": fill(SENTENCES["delivery"], rate=percent(rate, 1), employee=best)}


# On-time rate and the employee with the highest sales.
OPERATIONS_INSIGHT = Answer(
    ("employee", "orders"), ("sales",),
    lambda: {"best": winner_smallest_label("sales", F.struct("number", "name"), where=_of("employee")),
             "on_time": _value("orders", "on_time"), "dated": _value("orders", "dated")},
    _delivery_shown, flags=("on_time", "dated"))


# ---- cards: a number, its text, and the label beside it -------------------------------------------

def _card(asks: tuple[str, ...], needs: tuple[str, ...], numbers: Callable[[], Mapping[str, Column]], value: str, label: str,
          total: Callable[[Get], Column], text: Callable[[Column], Column], kind: str = "string") -> Answer:
    return Answer(asks, needs, numbers, lambda star, get: {
        value: total(get), label: get("winner").cast(kind), "value_text": text(total(get))})


# Line totals and the leading category.
TOTAL_SALES_CARD = _card(
    ("total", "category"), ("lt",),
    lambda: {"total": _value("total", "lt"), "winner": winner_or_blank("lt", "name", where=_of("category", member=True))},
    "line_total", "leading_category", lambda get: _double(get("total")), dollars)

# Orders and the product with the largest quantity.
TOTAL_ORDERS_CARD = _card(
    ("orders", "product"), ("quantity",),
    lambda: {"total": F.coalesce(_value("orders", "keys"), F.lit(0)), "winner": winner_or_blank("quantity", "name", where=_of("product"))},
    "total_orders", "most_ordered_product", lambda get: get("total").cast("bigint"), whole)

# Customers and the year with most of them.
ACTIVE_CUSTOMERS_CARD = _card(
    ("customers", "customers_of_year"), (),
    lambda: {"total": F.coalesce(_value("customers", "keys"), F.lit(0)),
             "winner": winner_or_blank("keys", "number", where=_of("customers_of_year", member=True))},
    "active_customers", "peak_year", lambda get: get("total").cast("bigint"), whole, "int")

# Line totals per order and the ship country with the highest.
AVERAGE_ORDER_CARD = _card(
    ("orders", "country"), ("lt",),
    lambda: {"total": _value("orders", "lt"), "orders": _value("orders", "keys"),
             "winner": winner_or_blank(m.ratio("lt", "keys"), "name", where=_of("country"))},
    "avg_order_value", "top_country", lambda get: m.ratio(_double(get("total")), _double(get("orders"))), dollars)

CARDS = {"total_sales": (TOTAL_SALES_CARD, "line_total", "leading_category"),
         "total_orders": (TOTAL_ORDERS_CARD, "total_orders", "most_ordered_product"),
         "active_customers": (ACTIVE_CUSTOMERS_CARD, "active_customers", "peak_year"),
         "avg_order_value": (AVERAGE_ORDER_CARD, "avg_order_value", "top_country")}

# The ten answers of the insights page.
INSIGHTS = {
    "growth_recommendation": GROWTH_RECOMMENDATION, "operations_recommendation": OPERATIONS_RECOMMENDATION,
    "buying_recommendation": BUYING_RECOMMENDATION, "selling_recommendation": SELLING_RECOMMENDATION,
    "seasonality_insight": SEASONALITY_INSIGHT, "seasonality_recommendation": SEASONALITY_RECOMMENDATION,
    "growth_insight": GROWTH_INSIGHT, "selling_insight": SELLING_INSIGHT,
    "buying_insight": BUYING_INSIGHT, "operations_insight": OPERATIONS_INSIGHT,
}

growth_recommendation, operations_recommendation, buying_recommendation, selling_recommendation = (
    partial(reply, a) for a in (GROWTH_RECOMMENDATION, OPERATIONS_RECOMMENDATION, BUYING_RECOMMENDATION, SELLING_RECOMMENDATION))
glance_recommendation, seasonality_insight, seasonality_recommendation = (
    partial(reply, a) for a in (GLANCE_RECOMMENDATION, SEASONALITY_INSIGHT, SEASONALITY_RECOMMENDATION))
growth_insight, selling_insight, buying_insight, operations_insight = (
    partial(reply, a) for a in (GROWTH_INSIGHT, SELLING_INSIGHT, BUYING_INSIGHT, OPERATIONS_INSIGHT))
total_sales_card, total_orders_card, active_customers_card, average_order_card = (
    partial(reply, a) for a in (TOTAL_SALES_CARD, TOTAL_ORDERS_CARD, ACTIVE_CUSTOMERS_CARD, AVERAGE_ORDER_CARD))


def insights_page(star: Star) -> DataFrame:
    """R17."""
    return page(star, INSIGHTS, lambda name, shown: [F.lit(name).alias("question"), shown["answer"].alias("answer")])


def growth_page(star: Star) -> DataFrame:
    """The four cards as rows of name, number, its text and label."""
    def entry(name: str, shown: Mapping[str, Column]) -> list[Column]:
        _, value, label = CARDS[name]
        return [F.lit(name).alias("card"), shown[value].cast("double").alias("value"), shown["value_text"].alias("value_text"),
                shown[label].cast("string").alias("label")]

    return page(star, {n: c[0] for n, c in CARDS.items()}, entry)


def glance_insight(star: Star, company: str) -> DataFrame:
    """M50."""
    row = m.values(star, (), "total_sales", "total_orders")
    year = F.coalesce(_one_year(star).cast("string"), F.lit(ALL_YEARS))
    row = row.withColumn("year", year)
    return row.withColumn("answer", fill(SENTENCES["glance_total"], year=F.col("year"), company=F.lit(company),
                                         sales=whole(F.col("total_sales")), orders=whole(F.col("total_orders"))))


# ---- stock ----------------------------------------------------------------------------------------

def inventory_insight(star: Star) -> DataFrame:
    """An empty count reads as blank."""
    shown = F.nullif(F.col("low_stock"), F.lit(0))
    return m.low_stock(star).withColumn("answer", fill(SENTENCES["stock"], count=shown))


def inventory_recommendation(star: Star) -> DataFrame:
    """M32."""
    text = F.when(F.col("low_stock") > 0, SENTENCES["stock_reorder"]).otherwise(SENTENCES["stock_ok"])
    return m.low_stock(star).withColumn("answer", text)
