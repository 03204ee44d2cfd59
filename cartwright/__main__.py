"""spark-submit entry: features, then segmentation."""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession

from cartwright.config import FeatureConfig, SegmentConfig
from cartwright.plans.workflow import run_all
from cartwright.session import tune


def main() -> None:
    logging.basicConfig(level=logging.INFO)
    parser = argparse.ArgumentParser(prog="cartwright")
    parser.add_argument("--feature_pipeline_config", required=True)
    parser.add_argument("--segmentation_config", required=True)
    parser.add_argument("--resume", action="store_true", help="pass over stages that a former run has finished on the same inputs")
    args = parser.parse_args()
    spark = tune(SparkSession.builder.appName("cartwright").getOrCreate())
    run_all(spark, FeatureConfig.load(args.feature_pipeline_config), SegmentConfig.load(args.segmentation_config), args.resume)


if __name__ == "__main__":
    main()
