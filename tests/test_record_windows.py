"""Windows of split records: none goes through the rest of a split anew for every line."""

from tablemend.session import scratch_path
from tablemend.sources import records


def test_no_frame_ends_with_the_partition(spark):
    path = scratch_path(spark, "frames")
    spark.range(4).selectExpr("concat(id, ',\"a\nb\"') AS value").coalesce(1).write.text(path)
    found = records.csv_records(spark, path)
    assert sorted(r.value for r in found.collect()) == [f'{i},"a\nb"' for i in range(4)]
    assert "unboundedfollowing" not in found._jdf.queryExecution().optimizedPlan().toString().lower()
