
from __future__ import annotations

import uuid
from collections.abc import Callable, Collection
from datetime import date, datetime, timedelta
from functools import cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from coverloom.operators import gate, quality, slicing, terms, versions
from coverloom.operators.enrich import agent_labels, with_member_context
from coverloom.operators.staging import Staged, stage_payments
from coverloom.operators.upsert import VERSION, upsert_payments
from coverloom.plans import analyst, dashboard, history, marts, rollups, warehouse
from coverloom.plans.catalog import CatalogMarts
from coverloom.schemas import RAW_SCHEMAS
from coverloom.session import clean_up, discard, fit_reducers, folders_made, input_bytes, shared_folder, tune, written_for, written_once
from coverloom.sources import GivenTables
from coverloom.sources.order_tables import AS_OF, SCHEMAS, OrderTables
from coverloom.sources.raw import read_csv_split
from coverloom.sources.store import Store
from coverloom.streaming.payments import FEED, merge_feed, merge_late, payment_feed
from oracle import sql

try:  # the folder may be taken out; the rest works without it
    import corpus_pipeline
    from coverloom.llm import queries as llm
except ModuleNotFoundError as missing:
    if missing.name not in ("coverloom.llm", "corpus_pipeline"):
        raise
    llm = None

Query = Callable[[SparkSession, str], DataFrame]


# Raw tables that plans with many uses work out once.
KEPT = ("policies", "payments")


def _staged(spark: SparkSession, sf_dir: str, keep: Collection[str] = ()) -> Staged:
    return Staged(OrderTables(spark, sf_dir, keep), AS_OF)


def _tables(spark: SparkSession, sf_dir: str) -> quality.Tables:
    return _tables_of(_staged(spark, sf_dir, KEPT))


def _tables_of(s: Staged) -> quality.Tables:
    return {
        **{table: (lambda table=table: s.raw[table]) for table in RAW_SCHEMAS},
        "dim_agents": lambda: marts.dim_agents(s),
        "fct_payments": lambda: marts.fct_payments(s),
        "fct_member_churn": lambda: marts.fct_member_churn(s),
        "agent_commission_summary": lambda: marts.agent_commission_summary(s),
    }


def _shown(query: Query) -> Query:
    """Registered results show DECIMAL as DOUBLE, because the two engines hand decimals to
    Python differently. The library itself keeps money exact."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = f"{sf_dir}/{{{','.join(SCHEMAS)}}}.parquet"
        frame = query(fit_reducers(tune(spark), input_bytes(spark, tables)), sf_dir)
        exact = {f.name for f in frame.schema.fields if isinstance(f.dataType, DecimalType)}
        return frame.select(*[F.col(c).cast("double") if c in exact else F.col(c) for c in frame.columns])

    return run


def _on_raw(build: Callable[[OrderTables], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(OrderTables(spark, sf_dir))


def _on_staged(build: Callable[[Staged], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(_staged(spark, sf_dir))


def _on_checks(build: Callable[[quality.Tables], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(_tables(spark, sf_dir))


def _policy_terms(raw: OrderTables) -> DataFrame:
    return terms.policy_terms(raw.signed_policies).select(
        "policy_id", "signed_on", "term_months", "plan_type", "effective_date", "expiry_date", "monthly_premium",
        "annual_premium", "commission_rate", "monthly_commission",
    )


def _cancellation_terms(raw: OrderTables) -> DataFrame:
    return terms.cancellation_terms(raw.cancelled_policies).select(
        "cancellation_id", "policy_id", "effective_date", "cancellation_date", "cancellation_reason",
        "monthly_premium", "months_active", "lifetime_value", "was_payment_failure",
    )


def _sliced_revenue(s: Staged) -> DataFrame:
    sliced = slicing.slice_by(
        with_member_context(s.payments, s.members, s.agents), "due_date", date(1997, 1, 1), date(2000, 12, 31), carriers=["MetLife", "VSP"],
        plan_types=["Dental Basic", "Vision Premium", "Dental+Vision Bundle"], tiers=["silver", "gold", "platinum"],
        states=["IN", "OH", "TX", "CA", "FL"],
    )
    return analyst.monthly_revenue(sliced)


def _scorecard(s: Staged) -> DataFrame:
    return dashboard.agent_scorecard(marts.agent_commission_summary_monthly(s), marts.dim_agents(s), s.policies, AS_OF)


SLICERS = slicing.Slicers(
    start=date(1996, 3, 1), end=date(1998, 8, 31), carriers=["VSP", "Zurich"],
    plan_types=["Dental Basic", "Dental Premium", "Dental+Vision Bundle"], tiers=["silver", "gold"],
)


def _cut_facts(s: Staged) -> tuple[DataFrame, DataFrame]:
    return SLICERS.cut(marts.fct_payments(s), "fct_payments"), SLICERS.cut(marts.fct_member_churn(s), "fct_member_churn")


def _sliced_scorecard(s: Staged) -> DataFrame:
    payments, churn = _cut_facts(s)
    monthly = marts.commission_summary_monthly(
        marts.billed_by_agent_from_fact(payments), marts.churned_by_agent(churn), s.agents
    )
    return dashboard.agent_scorecard(monthly, SLICERS.cut(marts.dim_agents(s), "dim_agents"), s.policies, date(1998, 8, 31))


def _sliced_tier_scatter(s: Staged) -> DataFrame:
    payments, churn = _cut_facts(s)
    summary = marts.commission_summary(
        marts.billed_by_agent_from_fact(payments, "carrier"), marts.churned_by_agent(churn), s.agents
    )
    return dashboard.tier_scatter(summary, s.agents)


NOW = datetime(2001, 9, 30, 12)
# Minutes before NOW of the newest load per carrier: a minute short of a day, a minute over, the same day.
LOADED = {"MetLife": 24 * 60 - 1, "VSP": 24 * 60 + 1, "Zurich": 11 * 60 + 30}


def _load_freshness(s: Staged) -> DataFrame:
    """The newest load per carrier. Payments due in December count as loaded after NOW."""
    found = []
    for carrier, minutes in LOADED.items():
        hours = F.make_dt_interval(hours=F.col("due_month").cast("int") - 1)
        at = F.when(F.col("due_month") == 12, F.lit(NOW + timedelta(minutes=5))).otherwise(F.lit(NOW - timedelta(minutes=minutes)) - hours)
        loads = s.payments.filter(F.col("carrier") == carrier).select(at.alias(VERSION))
        found.append(dashboard.freshness(loads, VERSION, NOW).withColumn("carrier", F.lit(carrier)))
    stacked = reduce(DataFrame.unionByName, found)
    return stacked.select("carrier", F.date_format("latest", "yyyy-MM-dd HH:mm:ss").alias("latest"), "age_hours", "is_stale")


def _top_agents(s: Staged) -> DataFrame:
    return analyst.top_agents(marts.agent_commission_summary(slicing.calendar_year(s, AS_OF)), AS_OF)


def _churn_risk(s: Staged) -> DataFrame:
    return analyst.churn_risk(s.payments, s.members, s.agents, AS_OF)


FIRST_LOAD_ENDS = date(2000, 1, 1)


def _before(s: Staged) -> Staged:
    """The other tables as they were at the first load: some agents in another tier, some
    members with another agent, late cancellations not known and some for another reason."""
    raw = s.raw
    moved, promoted = F.col("member_id").endswith("7"), F.col("agent_id").endswith("3")
    reason = F.col("cancellation_reason")
    return Staged(GivenTables(
        agents=raw.agents.withColumn("tier", F.when(promoted, "Bronze").otherwise(F.col("tier"))),
        members=raw.members.withColumn("agent_id", F.when(moved, "AGT000001").otherwise(F.col("agent_id"))),
        policies=raw.policies,
        payments=raw.payments,
        cancellations=raw.cancellations.filter(F.col("cancellation_date") < F.lit(FIRST_LOAD_ENDS))
        .withColumn("cancellation_reason", F.when(reason == "deceased", "member_request").otherwise(reason)),
    ), AS_OF)


def _raw_feeds(s: Staged) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The raw payments as two loads. The first holds what falls due before 2000, with late
    payments still open and checks booked a month early. The second brings the rest and the
    corrections; the third are the uncorrected rows once more, an out-of-date repeat."""
    early = F.col("due_date") < F.lit(FIRST_LOAD_ENDS)
    late, check = F.lower("payment_status") == "paid_late", F.lower("payment_method") == "check"
    raw = s.raw.payments
    first = raw.filter(early).withColumns({
        "payment_status": F.when(late, "Failed").otherwise(F.col("payment_status")),
        "paid_date": F.when(~late, F.col("paid_date")),
        "amount_paid": F.when(late, 0).otherwise(F.col("amount_paid")).cast("decimal(12,2)"),
        "due_date": F.when(check, F.add_months("due_date", -1)).otherwise(F.col("due_date")),
    })
    second = raw.filter(~early | late | check)
    return first, second, first.filter((F.col("payment_status") == "Failed") | check)


def _feeds(s: Staged) -> tuple[DataFrame, DataFrame]:
    """Two staged loads: the second brings the repeats as well, and both have rows without id
    or load time."""
    raw = s.raw.payments
    first, second, repeats = _raw_feeds(s)

    def loaded(frame: DataFrame, n: int | None) -> DataFrame:
        return stage_payments(frame.withColumn(VERSION, F.lit(n).cast("int")), VERSION)

    month = F.date_trunc("month", "due_date").cast("date")
    nameless = loaded(raw.filter(month == F.lit(date(1999, 12, 1))), 1).withColumn("payment_id", F.lit(None).cast("string"))
    undated = loaded(raw.filter(month == F.lit(date(1999, 11, 1))), None)
    odd = nameless.unionByName(undated)
    return loaded(first, 1).unionByName(odd), loaded(second, 2).unionByName(loaded(repeats, 1)).unionByName(odd)


@cache
def _loaded_in_steps(spark: SparkSession, sf_dir: str) -> Store:
    """A store after two loads, run once per session when a query first needs it: loads write."""
    store = Store(spark, shared_folder(spark, "incremental"))
    own, s = folders_made(), _staged(spark, sf_dir, KEPT)
    first, second = _feeds(s)
    kept = folders_made()  # what a step keeps aside is gone before the next
    upsert_payments(store, first)
    warehouse.refresh(store, _before(s))  # nothing built yet: this builds everything
    clean_up(spark, kept)
    upsert_payments(store, second)
    clean_up(spark, kept)
    stored = s.with_payments(warehouse.stored_payments(store, s, columns=warehouse.REACHED_BY))
    moved = s.members.filter(F.col("member_id").endswith("7"))
    promoted = s.agents.filter(F.col("agent_id").endswith("3"))
    warehouse.refresh(store, s, warehouse.touched_by_dimensions(stored, members=moved, agents=promoted))
    clean_up(spark, own)
    return store


def _step_table(table: str) -> Query:
    return lambda spark, sf_dir: _loaded_in_steps(spark, sf_dir).read(table)


def _step_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = lambda name: F.get_json_object("record", f"$.{name}")
    return _loaded_in_steps(spark, sf_dir).read("payment_rejects").select(
        "reason", record("payment_id").alias("payment_id"), record("policy_id").alias("policy_id"),
        record("due_date").cast("date").alias("due_date"), record("amount_due").cast("double").alias("amount_due"),
    )


@cache
def _streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payments as a stream of files: a load, then its corrections with the uncorrected rows
    once more, and at last rows whose load time lies behind the watermark by months."""
    base = shared_folder(spark, "streamed")
    own, s = folders_made(), _staged(spark, sf_dir, KEPT)
    store, feed = Store(spark, f"{base}/marts"), f"{base}/feed"
    first, second, repeats = _raw_feeds(s)
    belated = F.col("policy_id").endswith("7")

    def arrive(frame: DataFrame, day: date) -> None:
        at = F.lit(datetime.combine(day, datetime.min.time())).alias(VERSION)
        frame.select("*", at).select(*FEED.fieldNames()).write.mode("append").parquet(feed)
        merge_feed(payment_feed(spark, feed), store, f"{base}/fast", lateness="7 days").awaitTermination()

    arrive(first.filter(~belated), date(2001, 1, 1))
    arrive(repeats.filter(~belated), date(2001, 1, 1))
    arrive(second, date(2001, 6, 1))
    arrive(second.filter(F.month("due_date") == 1), date(2001, 6, 2))  # the watermark of the load before holds from here on
    arrive(first.filter(belated), date(2001, 1, 1))
    merge_late(payment_feed(spark, feed), store, f"{base}/late").awaitTermination()
    payments = warehouse.stored_payments(store, s)
    clean_up(spark, own)
    payments = written_once(payments, "streamed-payments")
    discard(spark, base)
    return payments


def _stream_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.fct_payments(_staged(spark, sf_dir).with_payments(_streamed(spark, sf_dir)))


def _stale_spans(s: Staged) -> DataFrame:
    """Spans without a load: a payment is loaded on the day it is paid, at a minute of its own."""
    minute = F.pmod(F.col("days_to_pay") * 97 + F.length("policy_id"), F.lit(1440)).cast("int")
    loads = s.payments.filter("paid_date is not null").select(
        "carrier", (F.col("paid_date").cast("timestamp") + F.make_dt_interval(mins=minute)).alias(VERSION)
    )
    shown = [F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("stale_from", "stale_until")]
    return history.stale_spans(loads, NOW).select("carrier", *shown, "stale_seconds")


@cache
def _dirty_file(spark: SparkSession, sf_dir: str) -> str:
    """The policies as a CSV file in which some dates are words and some amounts are none."""
    text = OrderTables(spark, sf_dir).policies.select(*[F.col(f.name).cast("string") for f in RAW_SCHEMAS["policies"].fields])
    digits = F.substring("policy_id", -2, 2)
    folder = shared_folder(spark, "dirty-csv")
    text.withColumns({
        "effective_date": F.when(digits == "21", "yesterday").otherwise(F.col("effective_date")),
        "monthly_premium": F.when(digits == "42", "n/a").otherwise(F.col("monthly_premium")),
    }).write.option("header", True).csv(folder)
    return folder


def _raw_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = read_csv_split(spark, _dirty_file(spark, sf_dir), "policies")
    return bad.select("policy_id", "effective_date", "monthly_premium", "status")


@cache
def _bitmaps(spark: SparkSession, sf_dir: str) -> str:
    s, base = _staged(spark, sf_dir), shared_folder(spark, "bitmaps")
    rollups.member_numbers(s.members).write.parquet(f"{base}/numbers")
    rollups.billed_members(s.payments, spark.read.parquet(f"{base}/numbers")).write.parquet(f"{base}/billed")
    return f"{base}/billed"


def _active_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.active_members(spark.read.parquet(_bitmaps(spark, sf_dir)), _staged(spark, sf_dir).agents)


@cache
def _cube(spark: SparkSession, sf_dir: str) -> rollups.CubeReader:
    s, folder = _staged(spark, sf_dir), shared_folder(spark, "cube")
    rollups.write_cube(rollups.revenue_cube(with_member_context(s.payments, s.members, s.agents)), folder)
    return rollups.CubeReader(spark.read.parquet(folder))


# What is asked of the cube: the last cuts by all slicers at once.
CUBE_SLICERS = {
    "all": slicing.Slicers(),
    "carrier": slicing.Slicers(carriers=["VSP"]),
    "plan_span": slicing.Slicers(plan_types=["Dental Basic", "Vision Basic"], start=date(1996, 1, 1), end=date(1997, 6, 30)),
    "tier_state": slicing.Slicers(tiers=["gold", "platinum"], states=["OH", "TX", "CA"]),
    "carrier_plan": slicing.Slicers(carriers=["MetLife", "Zurich"], plan_types=["Dental+Vision Bundle"]),
    "everything": slicing.Slicers(
        start=date(1997, 1, 1), end=date(1998, 12, 31), carriers=["MetLife", "VSP"], plan_types=["Dental Basic", "Vision Premium"],
        tiers=["bronze", "silver", "gold"], states=["IN", "OH", "TX", "WA", "NY"],
    ),
}


def _cube_sliced_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    cube = _cube(spark, sf_dir)
    return reduce(DataFrame.unionByName, [cube.monthly_revenue(s).withColumn("slicer", F.lit(name)) for name, s in CUBE_SLICERS.items()])


def _asof_fct_payments(s: Staged) -> DataFrame:
    """Members who moved to another agent in 1997 and agents promoted in 1998."""
    moved, promoted = F.col("member_id").endswith("7"), F.col("agent_id").endswith("3")
    first = date(1900, 1, 1)
    members = versions.versions_of(s.members.select("member_id", "agent_id"), {"agent_id": ("AGT000001", moved, date(1997, 7, 1))}, first)
    agents = versions.versions_of(agent_labels(s.agents), {"agent_tier": ("bronze", promoted, date(1998, 1, 15))}, first)
    return versions.fct_payments_as_of(s, members, agents)


def _dq_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _staged(spark, sf_dir, KEPT)
    others = {name: table() for name, table in _tables_of(s).items() if name != "fct_payments"}
    # The fact's two joins move whole payments: the first one's shuffles are gone before the second begins.
    with written_for(marts.placed_payments(s), "placed-payments") as placed:
        fact = gate.observed_report({"fct_payments": marts.fct_payments(s, placed)})
    return gate.observed_report(others).unionByName(fact)


def _composite_keys(s: Staged) -> DataFrame:
    """Keys of several columns: those of both summaries, and one that does not hold."""
    return reduce(DataFrame.unionByName, [
        quality.unique_together(marts.agent_commission_summary(s), "agent_commission_summary", "agent_id", "period", "carrier"),
        quality.unique_together(marts.agent_commission_summary_monthly(s), "agent_commission_summary_monthly", "agent_id", "period"),
        quality.unique_together(s.policies, "stg_policies", "member_id", "effective_date"),
    ])


@cache
def _catalog(spark: SparkSession, sf_dir: str) -> str:
    """Bucketed tables under a prefix of their own; policies with more than six payments count as hot."""
    s, prefix = _staged(spark, sf_dir), f"coverloom_{uuid.uuid4().hex[:12]}_"
    stored = CatalogMarts(spark, prefix, buckets=16, hot_rows=6)
    own = folders_made()
    stored.store_tables(s)
    clean_up(spark, own)
    stored.build_fact(s)
    return prefix


# ---- raw tables with planted defects -------------------------------------------------


def _dirty(spark: SparkSession, sf_dir: str, keep: Collection[str] = ()) -> Staged:
    """Every kind of check has something to find, cancellations have another agent than their
    member, and labels and keys are missing or unknown. What is changed goes by the last digits
    of the ids; the SQL oracle states the same."""
    raw = OrderTables(spark, sf_dir, keep)

    def digits(column: str, n: int) -> Column:
        return F.substring(column, -n, n)

    policy, member, agent = digits("policy_id", 2), digits("member_id", 1), digits("agent_id", 1)
    amount = F.when(policy == "55", F.lit(-5)).when(policy == "66", F.col("amount_due") * 2).otherwise(F.col("amount_paid"))
    payments = raw.payments.withColumns({
        "payment_status": F.when(policy == "11", "Refunded").when(policy != "22", F.col("payment_status")),
        "policy_id": F.when(policy == "33", F.concat(F.lit("POLX"), "policy_id")).when(policy != "44", F.col("policy_id")),
        "amount_paid": amount.cast("decimal(12,2)"),
        "payment_id": F.when(policy != "77", F.col("payment_id")),
        "member_id": F.when(policy == "99", "MEMX").otherwise(F.col("member_id")),
    })
    twice = F.explode(F.array_repeat(F.lit(0), F.when(policy == "88", 2).otherwise(1))).alias("copy")
    owner = F.col("agent_id")
    return Staged(GivenTables(
        agents=raw.agents.withColumn("tier", F.when(agent == "4", "Diamond").when(agent != "8", F.col("tier"))),
        members=raw.members.withColumn("agent_id", F.when(member == "5", "AGT999999").when(member != "6", owner)),
        policies=raw.policies.withColumn("status", F.when(policy == "12", "Lapsed").otherwise(F.col("status"))),
        payments=payments.select("*", twice).drop("copy"),  # one pass, where a union reads the payments twice
        cancellations=raw.cancellations.withColumns({
            "agent_id": F.when(digits("policy_id", 1) == "3", "AGT000002").otherwise(owner),
            "months_active": F.when(digits("policy_id", 1) == "7", -F.col("months_active")).otherwise(F.col("months_active")),
            "cancellation_reason": F.when(digits("policy_id", 1) != "9", F.col("cancellation_reason")),
        }),
    ), AS_OF)


def _on_dirty(build: Callable[[Staged], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(_dirty(spark, sf_dir))


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {
        # raw tables and contract arithmetic
        "raw_agents": _on_raw(lambda raw: raw.agents),
        "raw_members": _on_raw(lambda raw: raw.members),
        "raw_policies": _on_raw(lambda raw: raw.policies),
        "raw_payments": _on_raw(lambda raw: raw.payments),
        "raw_cancellations": _on_raw(lambda raw: raw.cancellations),
        "policy_terms": _on_raw(_policy_terms),
        "cancellation_terms": _on_raw(_cancellation_terms),
        "billing_schedule": _on_staged(lambda s: terms.billing_schedule(s.policies, AS_OF)),
        # staging
        "stg_agents": _on_staged(lambda s: s.agents),
        "stg_members": _on_staged(lambda s: s.members),
        "stg_policies": _on_staged(lambda s: s.policies),
        "stg_payments": _on_staged(lambda s: s.payments),
        "stg_cancellations": _on_staged(lambda s: s.cancellations),
        # marts
        "dim_agents": _on_staged(marts.dim_agents),
        "fct_payments": _on_staged(marts.fct_payments),
        "fct_member_churn": _on_staged(marts.fct_member_churn),
        "agent_commission_summary": _on_staged(lambda s: marts.in_report_order(marts.agent_commission_summary(s))),
        "agent_commission_summary_monthly": _on_staged(marts.agent_commission_summary_monthly),
        # analyst questions
        "q1_monthly_revenue": _on_staged(lambda s: analyst.monthly_revenue(s.payments)),
        "q2_top_agents": _on_staged(_top_agents),
        "q3_churn_by_reason": _on_staged(lambda s: analyst.churn_by_reason(marts.priced_cancellations(s))),
        "q4_eligibility_gap": _on_staged(lambda s: analyst.eligibility_gap(s.payments, s.cancellations, AS_OF)),
        "q5_churn_risk": _on_staged(_churn_risk),
        "q6_carrier_revenue": _on_staged(lambda s: analyst.carrier_revenue(marts.priced_payments(s))),
        # dashboard datasets
        "d1_exec_kpis": _on_staged(lambda s: dashboard.exec_kpis(marts.priced_payments(s), s.policies, AS_OF)),
        "d2_collection_trend": _on_staged(lambda s: dashboard.collection_trend(s.payments, AS_OF)),
        "d3_carrier_month": _on_staged(lambda s: dashboard.carrier_month(s.payments)),
        "d4_plan_mix": _on_staged(lambda s: dashboard.plan_mix(s.payments)),
        "d5_tier_scatter": _on_staged(lambda s: dashboard.tier_scatter(marts.agent_commission_summary(s), s.agents)),
        "d6_agent_scorecard": _on_staged(_scorecard),
        "d7_agent_kpis": _on_staged(lambda s: dashboard.agent_kpis(_scorecard(s))),
        "d8_churn_waterfall": _on_staged(lambda s: dashboard.churn_waterfall(s.cancellations)),
        "d9_churn_rate_plan": _on_staged(lambda s: dashboard.churn_rate_by_plan(s.cancellations, s.policies)),
        "d10_churn_monthly": _on_staged(lambda s: dashboard.churn_monthly(s.cancellations)),
        "d11_churn_state": _on_staged(lambda s: dashboard.churn_by_state(s.cancellations, s.members)),
        "d11_churn_risk_state": _on_staged(lambda s: dashboard.risk_by_state(_churn_risk(s))),
        "d12_early_cancel": _on_staged(lambda s: dashboard.early_cancel_watchlist(marts.fct_member_churn(s))),
        "d13_freshness": _on_staged(lambda s: dashboard.freshness(s.payments, "due_date", AS_OF)),
        "d13_load_freshness": _on_staged(_load_freshness),
        "sliced_revenue": _on_staged(_sliced_revenue),
        "sliced_churn": _on_staged(lambda s: analyst.churn_by_reason(_cut_facts(s)[1])),
        "sliced_scorecard": _on_staged(_sliced_scorecard),
        "sliced_tier_scatter": _on_staged(_sliced_tier_scatter),
        "agent_book": _on_staged(
            lambda s: marts.fct_payments(slicing.payments_of_agent(s, viewer_email="Agent7@Example.com"))
        ),
        # data checks
        **{
            f"dq_{kind}": _on_checks(lambda tables, kind=kind: quality.report(tables, [kind]))
            for kind in (quality.UNIQUE, quality.NOT_NULL, quality.ACCEPTED, quality.RELATED, quality.RANGE)
        },
        "dq_no_negative_commission": _on_staged(lambda s: quality.negative_commissions(marts.priced_payments(s))),
        "dq_report": _on_checks(lambda tables: quality.report(tables, apart=True)),
        "dq_composite_unique": _on_staged(_composite_keys),
        "dq_failing_values": _on_checks(lambda tables: quality.failing_values(tables, apart=True)),
        # incremental loading ends in the same marts as a full build
        "incr_payments": _step_table("fct_payments"),
        "incr_member_churn": _step_table("fct_member_churn"),
        "incr_dim_agents": _step_table("dim_agents"),
        "incr_commission_summary": _step_table("agent_commission_summary"),
        "incr_commission_summary_monthly": _step_table("agent_commission_summary_monthly"),
        "incr_rejects": _step_rejects,
        "stream_payments": _stream_payments,
        "raw_rejects": _raw_rejects,
        # stored summaries, history and layouts
        "d13_stale_spans": _on_staged(_stale_spans),
        "risk_history": _on_staged(lambda s: history.risk_history(s.payments, AS_OF)),
        "active_members_rollup": _active_members,
        "cube_sliced_revenue": _cube_sliced_revenue,
        "asof_fct_payments": _on_staged(_asof_fct_payments),
        "dq_observed": _dq_observed,
        "catalog_fct_payments": lambda spark, sf_dir: spark.table(_catalog(spark, sf_dir) + "fct_payments").select(*marts.PAYMENT_COLUMNS),
        # the same tables with planted defects
        "dirty_fct_payments": _on_dirty(marts.fct_payments),
        "dirty_member_churn": _on_dirty(marts.fct_member_churn),
        "dirty_commission_summary": _on_dirty(marts.agent_commission_summary),
        "dirty_dq_report": lambda spark, sf_dir: quality.report(_tables_of(_dirty(spark, sf_dir, KEPT)), apart=True),
    }
    shown = {name: _shown(query) for name, query in found.items()}
    return shown | llm.queries() | {"pipeline": corpus_pipeline.run} if llm else shown


def oracle_sql() -> dict[str, str]:
    return sql.statements() | (llm.oracle_sql() if llm else {})


def entry(spark: SparkSession) -> DataFrame:
    """Collection per month, the flagship report, on the smallest tables."""
    return queries()["q1_monthly_revenue"](spark, "/root/testdata/sf0.001")
