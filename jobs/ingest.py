"""spark-submit jobs/ingest.py --files 'in/*.zip' --raw out/raw_day"""

import argparse

from pyspark.sql import SparkSession

from aisflow.plans import ingest_days

if __name__ == "__main__":
    parser = argparse.ArgumentParser(description="Day files to typed Parquet; days already there are skipped")
    parser.add_argument("--files", required=True, nargs="+", help="paths or globs of zip or CSV day files")
    parser.add_argument("--raw", required=True, help="root of the raw table")
    parser.add_argument("--first", help="first day of a backfill, YYYY-MM-DD")
    parser.add_argument("--last", help="last day of a backfill")
    args = parser.parse_args()
    spark = SparkSession.builder.appName("ingest").getOrCreate()
    done = ingest_days.run(spark, args.files, args.raw, args.first, args.last)
    print(f"{len(done.read)} files read, {len(done.known_files)} ingested before, {done.n_rejected} rows without a time")
    for what, names in (("days without a file", done.missing_days), ("second files of a day", done.second_files)):
        if names:
            print(f"{what}: {', '.join(names)}")
