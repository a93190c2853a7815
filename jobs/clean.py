"""spark-submit jobs/clean.py --raw raw_day --profile vessel_profile --ais ais_data --year 2024"""

import argparse

from pyspark.sql import SparkSession

from aisflow.plans import clean_year

if __name__ == "__main__":
    parser = argparse.ArgumentParser(description="One year of raw pings to profiles and clean kinematics")
    parser.add_argument("--raw", required=True, help="root of the raw table")
    parser.add_argument("--profile", required=True, help="root of the profile table")
    parser.add_argument("--ais", required=True, help="root of the clean table")
    parser.add_argument("--year", required=True, type=int)
    parser.add_argument("--conflicts", help="write all conflicting profiles here")
    parser.add_argument("--state", help="keep each ship's values by year here, and profile all years of it")
    parser.add_argument("--lenient", action="store_true", help="do not stop at conflicting profiles")
    parser.add_argument("--keep-invalid-profiles", action="store_true", help="filter kinematics only")
    args = parser.parse_args()
    spark = SparkSession.builder.appName("clean").getOrCreate()
    clean_year.run(
        spark,
        args.raw,
        args.profile,
        args.ais,
        args.year,
        strict=not args.lenient,
        scope="pings" if args.keep_invalid_profiles else "all",
        conflicts_root=args.conflicts,
        state_root=args.state,
    )
