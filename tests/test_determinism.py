"""Same answer with 1 and 8 shuffle partitions."""

from collections import Counter

import __spark_entry__ as E
from tests.conftest import SF_SMALL


def test_documents_do_not_depend_on_partitioning(spark):
    results = []
    for n in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        results.append(Counter(map(tuple, E.queries()["doc_project"](spark, SF_SMALL).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1]
