from pathlib import Path

import pytest

from lapsewise import schemas as S
from lapsewise.__main__ import main
from lapsewise.sources.store import read_table
from lapsewise.workspace import shared_folder
from verification.order_history import billing_tables, hidden_profile

FOLDER = "/root/testdata/sf0.001"


def scratch_tables(spark):
    folder = Path(shared_folder(spark).removeprefix("file:")) / "lapsewise"
    return sorted(str(p) for p in folder.rglob("*.parquet"))


@pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="needs the test tables")
def test_every_job_from_csv_to_report(spark, tmp_path, capsys):
    csv, store, model, output = (str(tmp_path / n) for n in ("csv", "store", "model", "output"))
    for name, table in billing_tables(spark, FOLDER).items():
        table.write.option("header", True).csv(f"{csv}/{S.SOURCE_NAMES[name]}.csv")
    profile = f"{csv}/profile.csv"
    hidden_profile(spark, FOLDER).write.option("header", True).csv(profile)
    before = scratch_tables(spark)
    main(["seed", "--csv", csv, "--store", store])
    main(["seed", "--csv", csv, "--store", store])
    main(["profile", "--store", store])
    main(["segments", "--store", store, "--profile", profile])
    main(["baseline", "--store", store])
    main(["evaluate", "--store", store, "--model", model, "--output", output, "--trees", "20", "--depth", "5"])
    main(["explain", "--store", store, "--trees", "5"])
    main(["score", "--store", store, "--model", model])
    main(["score", "--store", store, "--model", model])
    main(["report", "--store", store, "--output", output])

    active = billing_tables(spark, FOLDER)[S.POLICIES].where("policy_status = 'Active'").count()
    history = read_table(spark, store, S.RISK_SCORE)
    assert history.count() == 2 * active
    (folder,) = Path(output).glob("risk_report_*")
    assert spark.read.option("header", True).csv(f"{folder}/policy_detail").count() == active
    shown = capsys.readouterr().out
    assert f"{active} policies scored" in shown
    for heading in ("adjusted_rand", "matched", "at_risk", "roc_auc"):
        assert heading in shown
    assert scratch_tables(spark) == before
