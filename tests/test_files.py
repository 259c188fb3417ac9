"""How many files and tasks the queries of files per household use."""

import glob

import pytest

from loadshift.catalog import tables


@pytest.fixture
def uncoalesced(spark):
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield spark
    spark.conf.set(name, before)


def test_a_house_is_written_to_one_file(uncoalesced, sf):
    """Not to one for each task of the aggregation."""
    path = tables._write_household_csv(uncoalesced, sf)
    houses = glob.glob(f"{path}/file=*")
    assert len(houses) > 1 and len(glob.glob(f"{path}/file=*/*.csv")) == len(houses)


def test_label_map_writes_no_house_files(spark, sf, monkeypatch):
    monkeypatch.setattr(tables, "_write_household_csv", None)
    assert tables.s3_label_map(spark, sf).count() == 3 * 7


def test_configs_are_written_by_several_tasks(spark, sf):
    path = tables._write_configs(spark, sf)
    names = [f.rsplit("/", 1)[1] for f in glob.glob(f"{path}/file=*/*.json")]
    assert len({n.split("-")[1] for n in names}) > 1
