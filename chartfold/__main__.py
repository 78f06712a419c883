"""spark-submit --py-files ... -m chartfold, or python -m chartfold."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from chartfold.plans import analysis, job


def main() -> None:
    parser = argparse.ArgumentParser(prog="chartfold", description=job.__doc__)
    parser.add_argument("source", help="folder of NDJSON files, or of ZIP archives")
    parser.add_argument("output")
    parser.add_argument("--archives", action="store_true", help="the source holds ZIP archives")
    parser.add_argument("--resources", nargs="+", default=[], help="resources to load beside the usual ones")
    parser.add_argument("--absolute", action="store_true", help="references may be whole URLs")
    parser.add_argument("--as-of", help="day for ages, yyyy-MM-dd (default: today)")
    parser.add_argument("--disease", default=analysis.DISEASE)
    parser.add_argument("--age", type=float, default=50, help="age to predict at")
    a = parser.parse_args()
    spark = SparkSession.builder.appName("chartfold").getOrCreate()
    reports = job.run(
        spark, a.source, a.output, a.resources, a.archives, a.as_of, a.disease, a.age, absolute=a.absolute
    )
    for name, report in reports.items():
        print(name)
        report.show(100, truncate=False)


if __name__ == "__main__":
    main()
