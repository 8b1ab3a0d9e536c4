"""The constraint table in blocks of account positions."""

from pyspark.sql import functions as F

from servelens import constants as K
from servelens.plans import constraints as C
from servelens.plans import runs
from servelens.sinks import wide
from servelens.sinks.writers import to_wide

from mini_model import build

KEYS = list(K.CONSTRAINT_KEYS)


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def values(spark, extra=()):
    m = build(spark)
    sel = C.select_accounts(m["accounts"], m["demand"], m["customers"])
    pc = m["constraints"]
    for c in extra:
        pc = pc.withColumn(c, F.concat(F.lit("x "), "facilityname"))
    return sel, C.build_account_constraints(pc, m["demand"], m["customers"], m["inventory_policies"], m["periods"], m["transfers"], sel,
                                            row_ids=True, extra=extra)


def test_blocks_equal_the_pivot_and_keep_extra_columns(spark, tmp_path):
    sel, acv = values(spark, ["plant"])
    codes = sorted(r.corp_code for r in sel.select("corp_code").distinct().collect())
    expected = to_wide(acv, codes, extra=["plant"])
    columns = [*KEYS, "constraintvalue", "plant", *[f"account_{c}" for c in codes]]
    assert expected.columns == columns
    for block in (1, 2, 256):
        root = str(tmp_path / str(block))
        wide.publish_blocks(acv, sel, root, extra=["plant"], block=block)
        got = wide.read_accounts(spark, root, codes, block=block)
        assert got.columns == columns and rows(got, *columns) == rows(expected, *columns)
        one = wide.read_accounts(spark, root, codes[:1], block=block)
        assert rows(one, *columns[:-1]) == rows(expected, *columns[:-1])
        long = wide.unpivot_accounts(spark, root, block)
        from servelens.operators.core import unpivot_prefixed
        cols = [*KEYS, "corp_code", "account_value"]
        assert rows(long, *cols) == rows(unpivot_prefixed(expected, [*KEYS, "constraintvalue"], "account_"), *cols)


def test_five_thousand_accounts(spark, tmp_path):
    n, root = 5000, str(tmp_path / "wide")
    accounts = spark.range(n).select(F.format_string("%05d", "id").alias("corp_code"))
    null = F.lit(None).cast("string")
    shared = spark.range(6).select(F.col("id").alias("row_id"), *[null.alias(k) for k in KEYS[1:]], F.concat(F.lit("F"), F.col("id").cast("string")).alias(KEYS[0]),
                                   F.lit(10.0).alias("constraintvalue"), null.alias("corp_code"), F.lit(10.0).alias("account_value"),
                                   F.lit(None).cast("bigint").alias("match_id"))
    own = shared.where("row_id < 5").drop("corp_code", "match_id").withColumn("match_id", F.col("row_id")).join(
        accounts.withColumn("row_id", F.col("corp_code").cast("int") % 7), "row_id").withColumn("account_value", F.col("corp_code").cast("double"))
    wide.publish_blocks(shared.unionByName(own), accounts, root)
    codes = ["00000", "00001", "00255", "00256", "04999", "04996"]
    got = {r.facilityname: r for r in wide.read_accounts(spark, root, codes).collect()}
    assert len(got) == 6
    for name, r in got.items():
        for c in codes:
            mine = int(c) % 7 == int(name[1:]) and int(name[1:]) < 5
            assert r[f"account_{c}"] == (float(c) if mine else 10.0), (name, c)
    long = wide.unpivot_accounts(spark, root)
    assert long.count() == 6 * n and long.where("account_value != 10").count() == own.where("account_value != 10").count()
    plan = wide.read_accounts(spark, root, codes[:1])._jdf.queryExecution().optimizedPlan().toString()
    assert "Pivot" not in plan and "04999" not in plan


def test_update_keeps_columns_beyond_the_keys(spark, tmp_path):
    m, root = build(spark), str(tmp_path)
    pc = m["constraints"].withColumn("plant", F.lit("P1")).withColumn("account_old", F.lit("1"))
    for name, df in [("customers", m["customers"]), ("periods", m["periods"]), ("customerdemand", m["demand"]),
                     ("inventorypolicies", m["inventory_policies"]), ("productionconstraints", pc)]:
        df.write.parquet(f"{root}/model/{name}")
    out = runs.update_constraints(spark, f"{root}/model", m["accounts"], m["transfers"], f"{root}/out")
    assert "plant" in out.columns and "account_old" not in out.columns and "account_81384" in out.columns
    assert {r.plant for r in out.collect()} == {"P1"}
