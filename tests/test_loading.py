import datetime
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path
from threading import Barrier
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from lapsewise import schemas as S
from lapsewise.operators import integrity
from lapsewise.plans.seeding import orphan_report, seed_all
from lapsewise.sources.store import append_new, read_table, stored_keys
from lapsewise.sources.tables import load_tables, read_csv_table, read_hidden_profile
from lapsewise.streaming.seeding import stream_all, stream_table
from lapsewise.workspace import durable, job, scratch_folder, shared_folder

FILES = {
    S.CUSTOMER: "customer_id,tax_id,c_first_name,c_last_name\nC1,T1,Ann,Lee\nC2,,Bo,\n",
    S.POLICIES: (
        "insurance_product,customer_id,policy_num,effective_start_date,effective_end_date,"
        "payment_frequency,policy_status,cancel_date\n"
        "Auto,C1,P1,2024-01-01,2025-01-01,Monthly,Cancelled,2024-04-01\n"
        "Home,C2,P2,2024-01-01,2025-01-01,Quarterly,Active,\n"
    ),
    S.INVOICE: (
        "policy_num,invoice_num,invoice_type,invoice_start_date,invoice_end_date,"
        "days_arrears_allowed,installment_num,premium\n"
        "P1,I1,Premium,2024-01-01,2024-01-31,30,1,10.50\n"
        "P2,I2,Refund,2024-01-01,2024-01-31,60,1,-5.00\n"
    ),
    S.PAYHISTORY: (
        "transaction_id,invoice_num,premium,pay_transaction_date,pay_transaction_status\n"
        "T1,I1,10.50,2024-01-09,Paid\nT2,I2,1.00,,Failed\nT2,I2,1.00,,Failed\n"
    ),
}


@pytest.fixture
def folder(tmp_path):
    for table, text in FILES.items():
        (tmp_path / f"{S.SOURCE_NAMES[table]}.csv").write_text(text)
    return str(tmp_path)


REORDERED = "tax_id,customer_id,c_first_name,c_last_name\nTAX9,C1,Ann,Lee\n"


def test_a_reordered_header_is_refused_by_both_readers(spark, tmp_path):
    (tmp_path / "files").mkdir()
    (tmp_path / "files" / "a.csv").write_text(REORDERED)
    (tmp_path / "tbl_customer.csv").write_text(REORDERED)
    with pytest.raises(Exception, match="(?i)header"):
        read_csv_table(spark, str(tmp_path), S.CUSTOMER).collect()
    store = str(tmp_path / "store")
    with pytest.raises(Exception, match="(?i)header"):
        stream_table(spark, str(tmp_path / "files"), store, S.CUSTOMER, str(tmp_path / "c")).awaitTermination(60)
    assert read_table(spark, store, S.CUSTOMER).isEmpty()


def test_plain_file_names_are_read_too(spark, tmp_path):
    (tmp_path / "customer.csv").write_text(FILES[S.CUSTOMER])
    assert read_csv_table(spark, str(tmp_path), S.CUSTOMER).count() == 2


def test_orphans_go_to_quarantine(spark, folder, tmp_path):
    store = str(tmp_path / "store")
    with open(f"{folder}/tbl_invoice.csv", "a") as f:
        f.write("P9,I9,Premium,2024-01-01,2024-01-31,30,1,1.00\n,I8,Premium,2024-01-01,2024-01-31,30,1,1.00\n")
    for new, kept_back in ((3, 1), (0, 0)):
        counts = {r.table_name: r for r in seed_all(spark, folder, store, "quarantine").collect()}
        assert (counts[S.INVOICE].new_rows, counts[S.INVOICE].quarantined_rows) == (new, kept_back)
    kept = read_table(spark, f"{store}/quarantine", S.INVOICE).collect()
    assert [(r.policy_num, r.invoice_num) for r in kept] == [("P9", "I9")]
    assert orphan_report(load_tables(spark, store)).isEmpty()
    # once the parent is there, the same file brings the row in
    with open(f"{folder}/tbl_policies.csv", "a") as f:
        f.write("Home,C2,P9,2024-01-01,2025-01-01,Quarterly,Active,\n")
    counts = {r.table_name: r.new_rows for r in seed_all(spark, folder, store, "quarantine").collect()}
    assert counts[S.INVOICE] == 1
    with pytest.raises(ValueError, match="on_orphan"):
        seed_all(spark, folder, store, "drop")


def test_csv_blanks_become_null_and_dates_are_dates(spark, folder):
    rows = {r.policy_num: r for r in read_csv_table(spark, folder, S.POLICIES).collect()}
    assert rows["P1"].cancel_date == datetime.date(2024, 4, 1)
    assert rows["P2"].cancel_date is None
    assert read_csv_table(spark, folder, S.CUSTOMER).where("customer_id = 'C2'").collect()[0].tax_id is None


def test_malformed_csv_fails(spark, tmp_path):
    (tmp_path / "tbl_invoice.csv").write_text(FILES[S.INVOICE] + "P1,I3,Premium,not a date,,30,1,1.00\n")
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        read_csv_table(spark, str(tmp_path), S.INVOICE).collect()


def test_normalize_dates_drops_the_time_and_keeps_null(spark):
    df = spark.sql("SELECT timestamp '2024-03-01 23:59:00' AS d, double('NaN') AS x UNION ALL SELECT NULL, 1.5")
    rows = integrity.normalize_dates(df, ["d"]).orderBy(F.desc_nulls_last("d")).collect()
    assert [tuple(r) for r in rows] == [(datetime.date(2024, 3, 1), None), (None, 1.5)]


def test_hidden_profile(spark, tmp_path):
    (tmp_path / "profile.csv").write_text("policy_num,hidden_profile\nP1,good\n")
    assert read_hidden_profile(spark, str(tmp_path / "profile.csv")).collect()[0].hidden_profile == "good"


def test_new_rows_skips_stored_keys_and_copies(spark):
    incoming = spark.createDataFrame([("a", 2), ("a", 1), ("b", 5), ("c", 7)], "k string, v int")
    stored = spark.createDataFrame([("b", 0)], "k string, v int")
    for order in ("v", "k"):  # the choice does not depend on the order of arrival
        got = integrity.new_rows(incoming.orderBy(F.desc(order)), stored, ["k"]).collect()
        assert sorted(map(tuple, got)) == [("a", 1), ("c", 7)]
    assert integrity.new_rows(incoming.limit(0), stored, ["k"]).count() == 0


def test_a_missing_key_fails(spark):
    incoming = spark.createDataFrame([(None, 1)], "k string, v int")
    with pytest.raises(Exception, match="k is NULL"):
        integrity.one_row_per_key(incoming, ["k"]).collect()


def test_orphans_are_counted_per_key_and_null_passes(spark):
    child = spark.createDataFrame([("x",), ("x",), ("p",), (None,)], "fk string")
    parent = spark.createDataFrame([("p",)], "pk string")
    assert [tuple(r) for r in integrity.orphan_keys(child, parent, "fk", "pk").collect()] == [("x", 2)]


def test_seeding_twice_adds_nothing(spark, folder, tmp_path):
    store = str(tmp_path / "store")
    first = {r.table_name: (r.new_rows, r.file_rows) for r in seed_all(spark, folder, store).collect()}
    assert first == {S.CUSTOMER: (2, 2), S.POLICIES: (2, 2), S.INVOICE: (2, 2), S.PAYHISTORY: (2, 3)}
    again = seed_all(spark, folder, store).collect()
    assert [r.new_rows for r in again] == [0, 0, 0, 0]
    tables = load_tables(spark, store)
    assert {t: df.count() for t, df in tables.items()} == dict.fromkeys(S.LOAD_ORDER, 2)
    assert orphan_report(tables).isEmpty()
    assert str(tables[S.INVOICE].where("invoice_num = 'I2'").collect()[0].premium) == "-5.00"


def test_seeding_refuses_orphans(spark, folder, tmp_path):
    with open(f"{folder}/tbl_invoice.csv", "a") as f:
        f.write("P9,I9,Premium,2024-01-01,2024-01-31,30,1,1.00\n")
    with pytest.raises(ValueError, match="P9"):
        seed_all(spark, folder, str(tmp_path / "store"))


def test_stored_rows_are_never_updated(spark, tmp_path):
    store = str(tmp_path)
    row = lambda name: spark.createDataFrame([("C1", None, name, None)], S.SCHEMAS[S.CUSTOMER])
    assert append_new(spark, store, S.CUSTOMER, row("Ann")) == 1
    assert append_new(spark, store, S.CUSTOMER, row("Bob")) == 0
    assert read_table(spark, store, S.CUSTOMER).collect()[0].c_first_name == "Ann"


def customers(spark, low, high):
    rows = spark.range(low, high).selectExpr("lpad(cast(id AS string), 8, '0')", "'tax'", "'Ann'", "'Lee'")
    return rows.toDF(*S.SCHEMAS[S.CUSTOMER].names)


def scanned_files(df):
    """Files that the plan's scans read after pruning, and all that lie in the folder."""
    df.collect()
    scans, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if node.nodeName().startswith("Scan parquet"):
            scans.append(node.metrics().apply("numFiles").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return sum(scans)


def test_an_append_of_few_keys_reads_few_files(spark, tmp_path):
    store = str(tmp_path)
    assert append_new(spark, store, S.CUSTOMER, customers(spark, 0, 2000)) == 2000
    files = len(list(Path(f"{store}/{S.CUSTOMER}").rglob("*.parquet")))
    assert files >= 16
    few = customers(spark, 1990, 2010)  # one in a hundred
    read = scanned_files(stored_keys(spark, store, S.CUSTOMER, few).select("customer_id"))
    assert 0 < read <= 20 < files
    assert append_new(spark, store, S.CUSTOMER, few) == 10
    assert append_new(spark, store, S.CUSTOMER, few) == 0
    assert append_new(spark, store, S.CUSTOMER, customers(spark, 0, 0)) == 0
    kept = read_table(spark, store, S.CUSTOMER)
    assert kept.columns == S.SCHEMAS[S.CUSTOMER].names
    assert (kept.count(), kept.select("customer_id").distinct().count()) == (2010, 2010)


def test_the_key_range_of_an_append_reaches_the_scan(spark, tmp_path, capsys):
    append_new(spark, str(tmp_path), S.CUSTOMER, customers(spark, 0, 50))
    stored_keys(spark, str(tmp_path), S.CUSTOMER, customers(spark, 10, 12)).explain()
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(customer_id" in plan and ">= 00000010)" in plan and "<= 00000011)" in plan
    assert "PartitionFilters: [" in plan and "key_bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_rows_are_written_once(spark, tmp_path):
    """An append stores no copy of its rows first."""

    def scratch():
        return sorted((Path(shared_folder(spark).removeprefix("file:")) / "lapsewise").rglob("*.parquet"))

    before = scratch()
    assert append_new(spark, str(tmp_path), S.CUSTOMER, customers(spark, 0, 100)) == 100
    assert scratch() == before
    assert len(list(tmp_path.rglob("*.parquet"))) <= 100


def test_only_rows_of_repeated_keys_are_grouped(spark):
    incoming = spark.createDataFrame([("a", 2), ("a", 1), ("b", 5), ("c", 7), ("c", 7)], "k string, v int")
    repeated = integrity.repeated_keys(incoming, ["k"])
    assert repeated.count() == 2
    for sent in (100, 1):  # more hashes than may be sent: all rows are grouped
        kept = integrity.keep_one_of_repeated(incoming, ["k"], repeated, sent)
        assert sorted(tuple(r) for r in kept.collect()) == [("a", 1), ("b", 5), ("c", 7)]
    unique = incoming.where("k = 'b'")
    kept = integrity.keep_one_of_repeated(unique, ["k"], integrity.repeated_keys(unique, ["k"]))
    assert kept.collect() == [("b", 5)]
    for keys in (["x", None], ["x", None, None]):
        missing = spark.createDataFrame([(k, 1) for k in keys], "k string, v int")
        with pytest.raises(Exception, match="k is NULL"):
            integrity.keep_one_of_repeated(missing, ["k"], integrity.repeated_keys(missing, ["k"])).collect()


def test_rows_of_single_keys_are_not_shuffled_to_be_told_apart(spark, capsys):
    unique = spark.range(100).selectExpr("cast(id AS string) AS k", "id AS v")
    integrity.keep_one_of_repeated(unique, ["k"], integrity.repeated_keys(unique, ["k"])).explain()
    assert "Exchange" not in capsys.readouterr().out


def test_jobs_in_threads_keep_their_own_folders(spark):
    both = Barrier(2)

    def run(n):
        with job(spark):
            folder = scratch_folder(spark)
            kept = durable(spark.range(n), "numbers")
            both.wait(60)
            if n == 5:  # ends last: the other's end must not take its rows
                both.wait(60)
            counted = kept.count()
        if n == 3:
            both.wait(60)
        return folder, counted

    with ThreadPoolExecutor(2) as pool:
        (a, n_a), (b, n_b) = pool.map(run, (3, 5))
    assert a != b and (n_a, n_b) == (3, 5)


def test_a_cluster_without_a_shared_folder_is_refused():
    def session(master):
        conf = SimpleNamespace(get=lambda key, default=None: "/warehouse" if key == "spark.sql.warehouse.dir" else default)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None))

    assert shared_folder(session("local[4]")) == "/warehouse"
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://host"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(session(master))


def test_stream_merges_new_files_only(spark, tmp_path):
    files, store, checkpoint = (tmp_path / n for n in ("files", "store", "checkpoint"))
    files.mkdir()
    header, *rows = FILES[S.CUSTOMER].splitlines()

    def run():
        query = stream_table(spark, str(files), str(store), S.CUSTOMER, str(checkpoint))
        assert query.awaitTermination(120)
        return sorted(r.customer_id for r in read_table(spark, str(store), S.CUSTOMER).collect())

    (files / "a.csv").write_text("\n".join([header, rows[0]]) + "\n")
    assert run() == ["C1"]
    (files / "b.csv").write_text("\n".join([header, *rows, rows[1]]) + "\n")
    assert run() == ["C1", "C2"]
    assert run() == ["C1", "C2"]


def test_stream_of_every_table_waits_for_parents(spark, tmp_path):
    files, store, checkpoint = (str(tmp_path / n) for n in ("files", "store", "checkpoint"))

    def arrive(table, text, name):
        (tmp_path / "files" / table).mkdir(parents=True, exist_ok=True)
        (tmp_path / "files" / table / name).write_text(text)

    for table, text in FILES.items():
        arrive(table, text, "a.csv")
    header = FILES[S.INVOICE].splitlines()[0]
    arrive(S.INVOICE, f"{header}\nP9,I9,Premium,2024-01-01,2024-01-31,30,1,1.00\n", "b.csv")
    with pytest.raises(Exception, match="P9"):
        stream_all(spark, files, store, checkpoint)

    header = FILES[S.POLICIES].splitlines()[0]
    arrive(S.POLICIES, f"{header}\nAuto,C1,P9,2024-01-01,2025-01-01,Monthly,Active,\n", "b.csv")
    stream_all(spark, files, store, checkpoint)
    counts = {t: df.count() for t, df in load_tables(spark, store).items()}
    assert counts == {S.CUSTOMER: 2, S.POLICIES: 3, S.INVOICE: 3, S.PAYHISTORY: 2}
