import pytest

from sluice.operators import quality as Q
from sluice.plans.flow import CONTROL_RULES
from sluice.sources.control import read_control, read_csv_text, with_row_number

from .conftest import write_text

HEADER = ("icdsTableName,BANNER_NAME,dataSensitivity,OP-Company code,dlSchemaName,dlTableName,"
          "tableLoadType,keyPreCombine,keyPrimaryKey,bucket_id\n")

# Invented values. One row per edge case; the comment gives the expected rule ids.
EDGE_ROWS = [
    ('SRC1,"MDD,MAK",se,"X-1",dl_zone_a,DOC_ONE,INC,ts,"k1,k2",11', []),
    ('SRC2,,se,,dl_zone_a,DOC_TWO,INC,ts,k1,12', ["banner_empty", "banner_invalid"]),
    ('SRC3,"   ",ns,,dl_zone_a,DOC_3,FULL,ts,k1,13', ["banner_empty", "banner_invalid"]),
    ('SRC4,"MDD,",hs,,dl_zone_a,DOC_4,inc,ts,k1,14', ["banner_invalid"]),
    ('SRC5," MAK , MSB",SE,,dl_zone_a,DOC_5,Full,ts,k1,15', []),
    ('SRC6,mdd,se,,dl_zone_a,DOC_6,INC,ts,k1,16', ["banner_invalid"]),
    ('SRC7,"MDD,MDD", se,,dl_zone_a,DOC_7,INC,ts,k1,17', ["sensitivity_invalid"]),
    ('SRC8,MSB,se,,dl_zone_a,DOC_8,DELTA,ts,k1,18', ["load_type_invalid"]),
    ('SRC9,MSB,se,,NA,None,INC,ts,k1,19', ["table_empty", "schema_empty"]),
    ('SRC10,MSB,se,,dl_zone_a, \t,INC,ts,k1,20', ["table_empty"]),
    ('SRC11,MSB,,,dl_zone_a,DOC_11,,ts,k1,21', ["sensitivity_invalid", "load_type_invalid"]),
]


@pytest.fixture()
def control_csv(tmp_dir):
    body = HEADER + "\n".join(r for r, _ in EDGE_ROWS[:5]) + "\n\n" + "\n".join(r for r, _ in EDGE_ROWS[5:]) + "\n"
    return write_text(f"{tmp_dir}/control.csv", body, newline="\r\n")


def test_findings_per_row_in_rule_order(spark, control_csv):
    df = read_control(spark, control_csv, ["BANNER_NAME", "dlTableName"])
    numbered = with_row_number(df, "row_id")
    found = Q.violations(numbered, CONTROL_RULES, "row_id").collect()
    by_row = {}
    for r in sorted(found, key=lambda r: (r.row_id, r.rule_pos)):
        by_row.setdefault(r.row_id, []).append(r.rule_id)
    expected = {i + 1: ids for i, (_, ids) in enumerate(EDGE_ROWS) if ids}
    assert by_row == expected


def test_offending_elements_reported(spark, control_csv):
    df = with_row_number(read_control(spark, control_csv, []), "row_id")
    found = {r.row_id: r.offending for r in Q.violations(df, CONTROL_RULES, "row_id").collect()
             if r.rule_id == "banner_invalid"}
    assert found[4] == ""          # "MDD," -> trailing empty element
    assert found[6] == "mdd"       # case-sensitive
    assert found[2] == "NULL"      # missing list


def test_na_tokens_read_as_null_and_whitespace_kept(spark, control_csv):
    rows = read_csv_text(spark, control_csv).collect()
    assert len(rows) == len(EDGE_ROWS)   # blank line skipped
    assert rows[8]["dlSchemaName"] is None and rows[8]["dlTableName"] is None
    assert rows[2]["BANNER_NAME"] == "   "
    assert rows[9]["dlTableName"] == " \t"


def test_gate_raises_and_split(spark, control_csv):
    df = with_row_number(read_control(spark, control_csv, []), "row_id")
    with pytest.raises(Q.ValidationError) as e:
        Q.gate(df, CONTROL_RULES, "row_id")
    assert "Row 2:" in str(e.value)
    valid, rejected = Q.split_valid(Q.flag(df, CONTROL_RULES))
    assert sorted(r.row_id for r in valid.collect()) == [1, 5]
    flagged, obs = Q.observe_quality(Q.flag(df, CONTROL_RULES))
    flagged.write.format("noop").mode("overwrite").save()
    assert obs.get == {"rows_seen": 11, "rows_bad": 9}


def test_missing_column_and_empty_file(spark, tmp_dir):
    p = write_text(f"{tmp_dir}/c.csv", "BANNER_NAME,dlTableName\nMDD,T\n")
    with pytest.raises(Q.ValidationError, match="dataSensitivity"):
        read_control(spark, p, ["BANNER_NAME", "dataSensitivity", "tableLoadType"])
    p = write_text(f"{tmp_dir}/e.csv", HEADER)
    with pytest.raises(Q.ValidationError, match="empty"):
        read_control(spark, p, ["BANNER_NAME"])


def test_row_number_is_input_order_across_partitions(spark):
    df = spark.range(0, 10007, numPartitions=7)
    out = with_row_number(df, "rn")
    assert out.filter("rn != id + 1").count() == 0
    assert out.count() == 10007


def test_row_number_follows_files(spark, tmp_dir):
    small = "".join(f"{i}\n" for i in range(5))
    large = "".join(f"{i}\n" for i in range(5, 5005))
    import os
    os.makedirs(f"{tmp_dir}/in")
    write_text(f"{tmp_dir}/in/a.csv", "n\n" + small)
    write_text(f"{tmp_dir}/in/b.csv", "n\n" + large)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")  # b.csv in several splits, read before a.csv
    out = with_row_number(read_csv_text(spark, f"{tmp_dir}/in"), "rn")
    assert out.filter("rn != cast(n as int) + 1").count() == 0 and out.count() == 5005
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_elements_against_a_table_equal_the_literal_rule(spark):
    from sluice.operators import quality as Q
    rows = [(1, "MAK, MDD"), (2, "MAK,xx , yy,xx"), (3, None), (4, ""), (5, "MDD,"), (6, "mak"), (7, "\tMDD ")]
    df = spark.createDataFrame(rows, "id int, list string")
    ref = spark.createDataFrame([("MAK",), ("MDD",), (None,), ("MAK",)], "v string")
    got = {r.row_id: r.offending for r in Q.elements_not_in(df, "id", "list", ref, "v").collect()}
    literal = Q.violations(df, [Q.Rule("f3", "list", "each_in", allowed=("MAK", "MDD"))], "id")
    assert got == {r.row_id: r.offending for r in literal.collect()}
    assert got[2] == "xx, yy, xx" and got[3] == "NULL" and 1 not in got and 7 not in got
