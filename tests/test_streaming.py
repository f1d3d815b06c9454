"""The harmonize plan on file streams: two batches of files, exactly-once output."""

import json

from blotter.streaming import harmonize_stream


def _write(path, rows):
    path.write_text("\n".join(json.dumps(r) for r in rows) + "\n")


def test_incremental_ingest(spark, tmp_path):
    a, c, out, ck = (tmp_path / n for n in ["a", "c", "out", "ck"])
    a.mkdir()
    c.mkdir()
    _write(a / "1.json", [{"ARREST_KEY": "1", "ARREST_DATE": "01/01/2019", "ARREST_BORO": "K", "AGE_GROUP": "<18"},
                          {"ARREST_KEY": "2", "ARREST_DATE": "01/01/2019", "AGE_GROUP": None}])
    _write(c / "1.json", [{"CMPLNT_NUM": "9", "CMPLNT_FR_DT": "02/02/2018", "SUSP_SEX": "F"}])
    q = harmonize_stream(spark, str(a), str(c), str(out), str(ck))
    q.awaitTermination(120)
    assert sorted(r.CMPLNT_NUM for r in spark.read.parquet(str(out)).collect()) == ["1", "9"]
    _write(a / "2.json", [{"ARREST_KEY": "3", "ARREST_DATE": "3/4/2019", "ARREST_BORO": "Q", "AGE_GROUP": "65+"}])
    q = harmonize_stream(spark, str(a), str(c), str(out), str(ck))
    q.awaitTermination(120)
    rows = {r.CMPLNT_NUM: r for r in spark.read.parquet(str(out)).collect()}
    assert sorted(rows) == ["1", "3", "9"]                 # old files not re-ingested
    assert rows["3"].BORO_NM == "QUEENS" and rows["3"].Year == 2019 and rows["1"].BORO_NM == "BROOKLYN"
