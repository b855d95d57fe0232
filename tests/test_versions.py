"""Tables replaced in one step."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from rows import PARAMS, claim, layer, remit

from remitwise.operators.checks import all_exceptions_fused
from remitwise.plans.register import exception_register, read_register, run_folder, write_run
from remitwise.sources import landing
from remitwise.sources.versions import POINTER, parts, publish, published

BROKEN = "if(id = 7, raise_error('the machine died'), cast(id as string)) as v"


def test_a_load_that_dies_leaves_the_former_rows(spark, tmp_path):
    path = str(tmp_path / "table")
    with pytest.raises(ValueError, match="nothing has landed"):
        landing.landed(spark, path)
    rows = spark.range(10).selectExpr("cast(id as string) as v")
    assert landing.land(rows, path).count() == 10
    with pytest.raises(Exception, match="the machine died"):
        landing.land(spark.range(0, 20, 1, 4).selectExpr(BROKEN), path)
    assert sorted(r.v for r in landing.landed(spark, path).collect()) == sorted(map(str, range(10)))


def test_old_versions_and_remains_go_but_the_last_one_stays(spark, tmp_path):
    path = str(tmp_path / "table")
    first = publish(spark.range(1), path)
    second = publish(spark.range(2), path)
    assert spark.read.parquet(first).count() == 1  # still there for its readers
    with pytest.raises(Exception, match="the machine died"):
        publish(spark.range(9).selectExpr(BROKEN), path)
    third = publish(spark.read.parquet(second).union(spark.range(1)), path)
    assert published(spark, path) == third and spark.read.parquet(third).count() == 3
    kept = {n for n in os.listdir(path) if n.startswith("version=")}
    assert kept == {os.path.basename(second), os.path.basename(third)}
    assert POINTER in os.listdir(path)
    assert parts(spark, str(tmp_path)) == [third] and parts(spark, str(tmp_path / "none")) == []


def test_a_run_that_dies_while_writing_leaves_the_former_run(spark, tmp_path):
    path = str(tmp_path / "register")
    built = layer(spark, [claim(i, provider_npi="1") for i in range(4)], [remit(i) for i in range(4)])
    found = exception_register(all_exceptions_fused(built, PARAMS), "A", dt.datetime(2026, 1, 1))
    assert read_register(spark, path).count() == 0
    write_run(found, path, "A")
    write_run(found.selectExpr("* except (run_id)", "'B/1' as run_id"), path, "B/1")
    before = sorted(map(tuple, read_register(spark, path).collect()))
    assert len(before) == 8
    dying = found.selectExpr("* except (finding)", "if(entity_key = 'C2', raise_error('the machine "
                             "died'), finding) as finding")
    with pytest.raises(Exception, match="the machine died"):
        write_run(dying, path, "A")
    assert sorted(map(tuple, read_register(spark, path).collect())) == before
    # A run that is rewritten from its own rows, and one without exceptions.
    write_run(read_register(spark, path, "A").limit(1), path, "A")
    assert read_register(spark, path, "A").count() == 1
    write_run(found.filter("false"), path, "B/1")
    assert read_register(spark, path, "B/1").count() == 0
    assert [r.run_id for r in read_register(spark, path).collect()] == ["A"]
    assert os.path.isdir(f"{path}/{run_folder('B/1')}")
