"""spark-submit jobs/publish.py --profile vessel_profile --ais ais_data --aggregate time_analysis_data"""

import argparse

from pyspark.sql import SparkSession

from aisflow.sinks import catalog

if __name__ == "__main__":
    parser = argparse.ArgumentParser(description="External tables and staging views over the written folders")
    parser.add_argument("--profile", required=True)
    parser.add_argument("--ais", required=True)
    parser.add_argument("--aggregate", required=True)
    parser.add_argument("--database")
    args = parser.parse_args()
    spark = SparkSession.builder.appName("publish").getOrCreate()
    catalog.publish(spark, args.profile, args.ais, args.aggregate, args.database)
