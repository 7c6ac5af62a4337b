import os

import pytest

import check
from __spark_entry__ import entry
from tiers.registry.oracles import all_oracles
from tiers.registry.queries import all_queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="sample tables are not there")


def test_every_query_has_its_sql():
    assert all_queries().keys() == all_oracles().keys()


def test_flagship(spark):
    assert entry(spark).columns[0] == "consumer_id"


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_agrees_with_its_sql(spark, name):
    good, text = check.compare(spark, check.connect(FOLDER), name, FOLDER)
    assert good, text
