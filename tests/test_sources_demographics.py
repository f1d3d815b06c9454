"""SRC1-SRC4, SNK1-SNK2, RSH1-RSH2, REG7 on files written to a temp folder."""

import json

import pytest

from blotter.operators.demographics import assemble_demographics, unpivot_years
from blotter.operators.harmonize import harmonize
from blotter.operators.regression import region_year_facts
from blotter.sources.readers import (corrupt_records, read_arrests, read_complaints, read_demographics_wide, read_feed,
                                     read_table)
from blotter.sources.writers import write_incidents, write_table
from blotter.schema import ARREST_SCHEMA, COMPLAINT_SCHEMA


def test_json_feeds_roundtrip_partitioned(spark, tmp_path):
    a = tmp_path / "arrests"
    a.mkdir()
    (a / "h.json").write_text("\n".join(json.dumps(r) for r in [
        {"ARREST_KEY": "1", "ARREST_DATE": "01/05/2018", "ARREST_BORO": "M", "AGE_GROUP": "18-24",
         "OFNS_DESC": "X", "EXTRA": "ignored"},
        {"ARREST_KEY": "2", "ARREST_DATE": "02/05/2019", "ARREST_BORO": "Q", "AGE_GROUP": "65+"}]) + "\n{bad json\n")
    c = tmp_path / "complaints"
    c.mkdir()
    (c / "c.json").write_text(json.dumps({"CMPLNT_NUM": "9", "CMPLNT_FR_DT": "03/01/2019",
                                          "SUSP_AGE_GROUP": "UNKNOWN", "BORO_NM": "BRONX"}) + "\n")
    arrests = read_arrests(spark, str(a))
    assert arrests.schema == ARREST_SCHEMA            # fixed schema, no inference
    inc = harmonize(arrests, read_complaints(spark, [str(c)]))
    out = tmp_path / "incidents"
    write_incidents(inc, str(out))
    assert sorted(p.name for p in out.iterdir() if p.is_dir()) == ["RECORD_TYPE=A", "RECORD_TYPE=C"]
    back = read_table(spark, str(out))
    assert back.count() == 3
    pruned = back.filter("RECORD_TYPE = 'A' AND Year = 2019")
    assert [r.CMPLNT_NUM for r in pruned.collect()] == ["2"]
    assert "PartitionFilters: [isnotnull(RECORD_TYPE" in pruned._jdf.queryExecution().executedPlan().toString() \
        or pruned.count() == 1
    from blotter.operators.harmonize import since
    recent = since(back, "2019-01-01")
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "Year" in plan.split("PartitionFilters")[1][:200]
    assert sorted(r.CMPLNT_NUM for r in recent.collect()) == ["2", "9"]
    csv_dir = tmp_path / "csv"
    write_table(back.select("CMPLNT_NUM", "BORO_NM"), str(csv_dir))
    assert read_table(spark, str(csv_dir), fmt="csv").count() == 3


def test_duplicate_source_path_rejected(spark, tmp_path):
    with pytest.raises(ValueError):
        read_feed(spark, [str(tmp_path), str(tmp_path)], ARREST_SCHEMA)


def test_demographics_assembly(spark, tmp_path):
    def wide_csv(name, rows):
        p = tmp_path / f"{name}.csv"
        p.write_text("Sub-Borough Area,short_name,long_name,2006,2007\n" + "\n".join(rows) + "\n")
        return read_demographics_wide(spark, str(p), ["2006", "2007"], entity_alias="Sub-Borough Area")

    parts = {
        "proverty_rate": unpivot_years(wide_csv("p", ["Mott Haven,mh,Mott,1.5,2.5", "Astoria,as,Ast,3,"]),
                                       "proverty_rate", ["2006", "2007"]),
        "population": unpivot_years(wide_csv("q", ["Mott Haven,mh,Mott,100,junk"]),
                                    "population", ["2006", "2007"]),
    }
    demo = assemble_demographics(parts)
    # a year missing from the file is an all-NULL column, not an error
    wide3 = read_demographics_wide(spark, str(tmp_path / "q.csv"), ["2006", "2007", "2008"],
                                   entity_alias="Sub-Borough Area")
    assert wide3.columns == ["Borough", "short_name", "long_name", "2006", "2007", "2008"]
    assert wide3.first()["2008"] is None
    got = sorted((r.Borough, r.Year, r.proverty_rate, r.population, r.Demo_Key) for r in demo.collect())
    # Astoria is absent from one measure -> inner join drops it; junk/empty cells are NULL
    assert got == [("MOTT HAVEN", "2006", 1.5, 100.0, "MOTT HAVEN2006"),
                   ("MOTT HAVEN", "2007", 2.5, None, "MOTT HAVEN2007")]
    inc = spark.createDataFrame([("1", "C", "MOTT HAVEN", 2006), ("2", "C", "MOTT HAVEN", 2006),
                                 (None, "C", "MOTT HAVEN", 2006), ("3", "A", "MOTT HAVEN", 2006),
                                 ("4", "C", "MOTT HAVEN", 2005)],
                                "CMPLNT_NUM string, RECORD_TYPE string, BORO_NM string, Year int")
    facts = region_year_facts(inc, demo, ["2006", "2007"], ["MOTT HAVEN"], measures=list(parts))
    assert [(r.Key, r.crime_count, r.population) for r in facts.collect()] == [("MOTT HAVEN2006", 2, 100.0)]


def test_csv_feed_and_json_sink(spark, tmp_path):
    from blotter.schema import COMPLAINT_SCHEMA
    src = tmp_path / "c.csv"
    src.write_text("CMPLNT_NUM,CMPLNT_FR_DT,SUSP_AGE_GROUP,BORO_NM\n1,01/02/2019,<18,BRONX\n2,junk,,QUEENS\n")
    c = read_feed(spark, str(src), COMPLAINT_SCHEMA, fmt="csv")
    assert c.schema == COMPLAINT_SCHEMA                       # fields matched by header name
    first = c.filter("CMPLNT_NUM = '1'").first()
    assert (first.SUSP_AGE_GROUP, first.BORO_NM, first.CMPLNT_FR_TM) == ("<18", "BRONX", None)
    a = spark.createDataFrame([], ARREST_SCHEMA)
    inc = harmonize(a, c)
    out = tmp_path / "json_out"
    write_incidents(inc, str(out), fmt="json")
    back = spark.read.json(str(out))
    assert sorted(r.CMPLNT_NUM for r in back.collect()) == ["1", "2"]
    assert {p.name for p in out.iterdir() if p.is_dir()} == {"RECORD_TYPE=C"}


def test_corrupt_json_lines_are_no_records(spark, tmp_path):
    (tmp_path / "c.json").write_text('{"CMPLNT_NUM": "1", "OFNS_DESC": "X"}\n\n{"CMPLNT_NUM": "2", "OFNS\nnot json\n{}\n')
    feed = read_feed(spark, str(tmp_path), COMPLAINT_SCHEMA)
    assert feed.count() == 2 and feed.columns == COMPLAINT_SCHEMA.fieldNames()
    assert sorted(r.CMPLNT_NUM or "" for r in feed.collect()) == ["", "1"]
    bad = corrupt_records(spark, str(tmp_path), COMPLAINT_SCHEMA)
    assert sorted(r.value for r in bad.collect()) == ["not json", '{"CMPLNT_NUM": "2", "OFNS']
