"""spark-submit jobs/aggregate.py --ais ais_data --out time_analysis_data --year 2024"""

import argparse

from pyspark.sql import SparkSession

from aisflow.operators.proximity import DEFAULT_RADIUS_M
from aisflow.plans import aggregate_year
from aisflow.sources import ports

if __name__ == "__main__":
    parser = argparse.ArgumentParser(description="Nearest port and gap to the previous ping")
    parser.add_argument("--ais", required=True, help="root of the clean table")
    parser.add_argument("--out", required=True, help="root of the aggregate table")
    parser.add_argument("--year", required=True, type=int)
    parser.add_argument("--ports", help="port CSV; the built-in list when left out")
    parser.add_argument("--radius-m", type=float, default=DEFAULT_RADIUS_M)
    parser.add_argument("--carry-over", action="store_true", help="measure from the last ping of the year before")
    parser.add_argument("--legacy-sign", action="store_true", help="count minutes backwards")
    args = parser.parse_args()
    spark = SparkSession.builder.appName("aggregate").getOrCreate()
    known = ports.read_ports(spark, args.ports) if args.ports else ports.us_ports(spark)
    aggregate_year.run(
        spark,
        args.ais,
        known,
        args.out,
        args.year,
        carry_over=args.carry_over,
        radius_m=args.radius_m,
        legacy_sign=args.legacy_sign,
    )
