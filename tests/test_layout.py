"""Co-located layout: same results as the usual operators, no exchange of facts, pruned months."""

import uuid
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from loyalflow.operators import churn_features as cf
from loyalflow.operators import colocated
from loyalflow.operators import profile as prof
from loyalflow.operators import rfm
from loyalflow.params import DEFAULT as P
from loyalflow.sources import layout
from loyalflow.sources.staging import staged_domain


@pytest.fixture(scope="module")
def domain(spark, sf_small):
    return staged_domain(spark, sf_small)


def made(domain, **options):
    name = f"t_{uuid.uuid4().hex[:8]}"
    return name, layout.write_layout(domain, name, **options)


@pytest.fixture(scope="module")
def lay(domain):
    return made(domain)[1]


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    cols = sorted(df.columns)
    rounded = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in sorted(df.dtypes)]
    return Counter(map(tuple, df.select(*rounded).select(*cols).collect()))


def usual(d):
    x = cf.feature_transactions(d.trx, d.cust, P)
    return {"rfm": rfm.rfm_aggregate(d.trx, d.cust, d.prog, P), "profile": prof.purchase_profile(d.trx, d.cust, d.best, d.prog, P),
            "features": cf.transaction_features(x)}


def laid_out(lay):
    return {"rfm": colocated.rfm_aggregate(lay, P), "profile": colocated.purchase_profile(lay, P),
            "features": colocated.transaction_features(lay, P)}


def test_same_results_with_and_without_hot_customers(spark, domain):
    """Hot customers (here: of more than 60 rows) and an unknown unique customer are apart, and nothing is lost."""
    odd = domain.cust.orderBy("customer_id").limit(1).select("customer_id").first()[0]
    d = replace(domain, cust=domain.cust.withColumn(
        "unique_customer_id", F.when(F.col("customer_id") != odd, F.col("unique_customer_id"))))
    want = {k: rows(v) for k, v in usual(d).items()}
    for options in ({}, {"hot_rows": 60, "buckets": 3}):
        _, lay = made(d, **options)
        both = lay.trx.select(*layout.CUSTOMER).distinct().join(
            lay.apart.select(*layout.CUSTOMER).distinct(), layout.CUSTOMER)
        assert both.count() == 0
        assert (lay.apart.where("unique_customer_id IS NOT NULL").count() > 0) == bool(options)
        for name, df in laid_out(lay).items():
            assert rows(df) == want[name], name


def test_facts_are_not_exchanged(lay, no_broadcast):
    frames = laid_out(lay)
    for name in ("rfm", "profile"):
        assert "Exchange hashpartitioning" not in plan(frames[name]), name
        assert "Exchange rangepartitioning" not in plan(frames[name]), name
    assert "Exchange hashpartitioning" not in plan(colocated.all_data(lay, P))
    live = lay.cust.where("is_deleted = 0").select("firm_id", "customer_id", "unique_customer_id")
    x = colocated.with_customers(cf.priced_transactions(lay.trx, P), live).select(*cf.LAG_COLS)
    lagged = cf.with_previous_date(x, hot_rows=None).groupBy(*cf.KEYS).agg(*cf._feature_aggs())
    assert "Exchange" not in plan(lagged) and "Window" in plan(lagged)


def test_medians_lie_within_the_buckets(lay, no_broadcast):
    made_of = plan(colocated.transaction_features(lay, P))
    assert "Exchange" not in made_of and "Window" in made_of


def scanned(df):
    """Files that the scans of a finished query read."""
    def walk(p):
        if p.nodeName().startswith("Scan parquet"):
            yield p.metrics().apply("numFiles").value()
        if p.nodeName() == "AdaptiveSparkPlan":
            yield from walk(p.executedPlan())
        elif "QueryStage" in p.nodeName():
            yield from walk(p.plan())
        for i in range(p.children().size()):
            yield from walk(p.children().apply(i))

    df._jdf.queryExecution().executedPlan().executeCollect()
    return list(walk(df._jdf.queryExecution().executedPlan()))


def test_windows_read_their_months_only(spark, lay):
    months = [r[0] for r in lay.trx.select("month").distinct().orderBy("month").collect()]
    from_key, to_key = months[len(months) // 2] * 100 + 15, months[-2] * 100 + 3
    got = layout.window(lay.trx, from_key, to_key)
    want = lay.trx.where(F.col("timed_id_transaction").between(from_key, to_key))
    assert got.count() == want.count() > 0
    assert "PartitionFilters: [isnotnull(month" in plan(got)
    count = [F.count(F.lit(1))]
    (few,), (all_files,) = scanned(got.agg(*count)), scanned(lay.trx.agg(*count))
    assert 0 < few < all_files
    # tenants' own windows: pruned at run time
    firms = [r[0] for r in lay.prog.select("firm_id").distinct().orderBy("firm_id").collect()]
    own = [(firms[0], from_key, to_key), (firms[1], to_key, to_key + 20), (firms[-1], to_key, from_key)]
    windows = spark.createDataFrame(own, f"firm_id {lay.trx.schema['firm_id'].dataType.simpleString()}, from_key int, to_key int")
    got = layout.window_by_firm(lay.trx, windows)
    want = {}
    for firm, lo, hi in own:
        n = lay.trx.where((F.col("firm_id") == firm) & F.col("timed_id_transaction").between(lo, hi)).count()
        want |= {firm: n} if n else {}
    assert dict(map(tuple, got.groupBy("firm_id").count().collect())) == want
    assert "dynamicpruning" in plan(got).lower()
    assert min(n for n in scanned(got.agg(*count)) if n > 1) < all_files
    assert got.columns == lay.trx.columns


def test_appended_facts(spark, domain):
    """New transactions reach the tables of their customers, and only the folders of their months get files."""
    months = sorted(r[0] for r in domain.trx.select(layout.month_of(F.col("timed_id_transaction"))).distinct().collect())
    late = layout.month_of(F.col("timed_id_transaction")) >= months[-3]
    name, before = made(replace(domain, trx=domain.trx.where(~late)), hot_rows=90)
    files = set(before.trx.inputFiles())
    after = layout.append_facts(spark, name, domain.trx.where(late))
    assert files < set(after.trx.inputFiles())
    assert {int(f.split("month=")[1][:6]) for f in set(after.trx.inputFiles()) - files} <= set(months[-3:])
    want = {k: rows(v) for k, v in usual(domain).items()}
    for key, df in laid_out(after).items():
        assert rows(df) == want[key], key
    layout.drop_layout(spark, name)
    assert not spark.catalog.tableExists(f"{name}_trx")


def test_empty_tables(domain):
    empty = {t: getattr(domain, t).limit(0) for t in ("trx", "cust", "best", "prog")}
    _, lay = made(replace(domain, **empty))
    assert lay.apart is None
    for df in laid_out(lay).values():
        assert df.count() == 0


def test_buckets_follow_the_rows(spark, domain, monkeypatch):
    """More shuffle partitions make no more files: buckets are counted by rows and cores, up to the partitions."""
    cores, before = spark.sparkContext.defaultParallelism, spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(3 * cores))
    few = replace(domain, trx=domain.trx.limit(10 * cores))

    def buckets():
        name, _ = made(few)
        return int({r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}_trx").collect()}["Num Buckets"])

    try:
        assert buckets() == cores
        for rows, want in ((5, 2 * cores), (1, 3 * cores)):
            monkeypatch.setattr(layout, "ROWS_A_BUCKET", rows)
            assert layout._buckets(few.trx) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_facts_apart_are_found_without_an_exchange(spark, no_broadcast):
    """Ids of hot and unknown customers are broadcast to the facts, which are not joined whole a second time."""
    cust = spark.createDataFrame(
        [(1, 10, 100), (1, 11, 100), (1, 11, 100), (1, 12, None), (2, 10, 100), (2, 13, 104), (None, 14, 106), (2, None, 108)],
        "firm_id long, customer_id long, unique_customer_id long")
    ids = [(1, 10), (1, 11), (1, 11), (1, 12), (2, 10), (2, 13), (2, 13), (2, 99), (None, 14), (2, None)]
    trx = spark.createDataFrame([(f, 20000101 + i, c, i) for i, (f, c) in enumerate(ids)],
                                "firm_id long, timed_id_transaction int, customer_id long, transaction_id long")
    for hot, far in (([(1, 100)], {0, 1, 2, 3}), ([], {3}), ([(2, 104), (1, 100)], {0, 1, 2, 3, 5, 6})):
        rest, apart = layout._dealt(trx, cust, spark.createDataFrame(hot, "firm_id long, unique_customer_id long"))
        assert "SortMergeJoin" not in plan(apart) and "BroadcastHashJoin" in plan(apart)
        assert sorted(r.transaction_id for r in apart.collect()) == sorted(far)
        assert sorted(r.transaction_id for r in rest.collect()) == sorted({0, 1, 2, 3, 4, 5, 6} - far)
        assert rest.columns == apart.columns == [
            "firm_id", "customer_id", "timed_id_transaction", "transaction_id", "unique_customer_id", "month"]
        assert {r.month for r in rest.collect()} == {200001}
