import pytest
from pyspark.sql import functions as F

from cutpoint.sources import quarantine as Q
from cutpoint.sources.contract import ContractError

SCHEMA = "id long, score double, label tinyint"
LINES = ["id,score,label", "1,0.5,1", "2,abc,0", "3,0.25", "4,0.5,9", "5,,1", "6,1.5,0", '7,"0.75",0', "8,0.1,1,extra", "9,NaN,0", "10,0.9,"]


def rules():
    return {"label": F.col("label").isin(0, 1), "score": F.col("score").between(0.0, 1.0)}


@pytest.fixture()
def load(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "a.csv").write_text("\n".join(LINES[:6]) + "\n")
    (tmp_path / "raw" / "b.csv").write_text("\n".join([LINES[0], *LINES[6:]]) + "\n")
    return Q.load_csv(spark, str(tmp_path / "raw"), SCHEMA, str(tmp_path / "out"), rules())


def test_good_and_bad_rows_part(spark, load):
    assert sorted(map(tuple, load.good(spark).collect())) == [(1, 0.5, 1), (7, 0.75, 0)]
    bad = {(r["_raw"].split(",")[0], r["_reason"]): r for r in load.bad(spark).collect()}
    assert sorted(bad) == sorted([("2", "malformed"), ("3", "malformed"), ("8", "malformed"), ("4", "label"), ("5", "score"),
                                  ("6", "score"), ("9", "score"), ("10", "label")])
    assert bad["2", "malformed"]["_raw"] == "2,abc,0" and bad["2", "malformed"]["_file"].endswith("a.csv")
    assert bad["8", "malformed"]["_file"].endswith("b.csv")
    assert {r["reason"]: r["rows"] for r in load.counts(spark).collect()} == {"loaded": 2, "malformed": 3, "label": 2, "score": 3}


def test_only_good_rows(spark, tmp_path):
    (tmp_path / "x.csv").write_text("id,score,label\n1,0.5,1\n")
    load = Q.load_csv(spark, str(tmp_path / "x.csv"), SCHEMA, str(tmp_path / "out"))
    assert load.good(spark).count() == 1 and load.bad(spark).count() == 0


def test_kept_names_are_refused(spark, tmp_path):
    with pytest.raises(ContractError, match="_reason"):
        Q.load_csv(spark, str(tmp_path), "id long, _reason string", str(tmp_path / "out"))
