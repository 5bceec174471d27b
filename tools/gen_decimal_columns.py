"""Regenerate tillroll/oracle_decimals.py: the DECIMAL result columns of each
registered query (read from the Spark schemas at sf0.001)."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql.types import DecimalType  # noqa: E402

from tillroll.queries import _coverage_queries, _dashboard_queries, _ingest_queries, _mart_queries, _study_queries  # noqa: E402
from tillroll.session import get_spark  # noqa: E402


def main():
    spark = get_spark()
    raw = {}
    for part in (_mart_queries, _coverage_queries, _dashboard_queries, _study_queries, _ingest_queries):
        raw.update(part())
    out = {}
    for name, fn in raw.items():
        df = fn(spark, "/root/testdata/sf0.001")
        out[name] = [f.name for f in df.schema.fields if isinstance(f.dataType, DecimalType)]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tillroll", "oracle_decimals.py")
    with open(path, "w") as f:
        f.write('"""DECIMAL result columns per query (generated by tools/gen_decimal_columns.py).\n\n'
                'The oracle casts these to DOUBLE, as the registry boundary does on the Spark side."""\n\n')
        f.write("DECIMAL_COLUMNS = {\n")
        for name in sorted(out):
            f.write(f"    {name!r}: {out[name]!r},\n")
        f.write("}\n")
    print("wrote", path, len(out))


if __name__ == "__main__":
    main()
