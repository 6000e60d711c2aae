"""Print the physical plan of catalog keys: python scripts/explain.py sf_dir key [mode]"""
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from vigil.plans.catalog import QUERIES  # noqa: E402
from vigil.session import get_session  # noqa: E402

spark = get_session("local[8]", shuffle_partitions=8)
spark.sparkContext.setLogLevel("ERROR")
sf_dir, key = sys.argv[1], sys.argv[2]
mode = sys.argv[3] if len(sys.argv) > 3 else "formatted"
df = QUERIES[key](spark, sf_dir)
if mode == "final":
    df.write.format("noop").mode("overwrite").save()
    print(df._jdf.queryExecution().executedPlan().toString())
else:
    df.explain(mode)
