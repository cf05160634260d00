"""Run the layers once: ``spark-submit`` or ``python -m minutefold --input-dir … --root …``.

Other settings come from ``MINUTEFOLD_<FIELD>`` in the environment, an object store's endpoint and
keys from ``MINUTEFOLD_S3_ENDPOINT``, ``MINUTEFOLD_S3_ACCESS_KEY`` and ``MINUTEFOLD_S3_SECRET_KEY``.
"""

from __future__ import annotations

import argparse
import json
import logging

from pyspark.sql import SparkSession

from .config import Settings, object_store_from_env
from .plans.run import run


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="minutefold", description=__doc__)
    parser.add_argument("--input-dir", required=True, help="folder of the three source files")
    parser.add_argument("--root", required=True, help="folder of the layers")
    parser.add_argument("--run-id", help="repeat it to retry a run that failed")
    given = {k: v for k, v in vars(parser.parse_args(argv)).items() if v is not None}

    logging.basicConfig(level=logging.INFO)
    spark = SparkSession.builder.appName("minutefold").config(map=object_store_from_env()).getOrCreate()
    result = run(spark, Settings.from_env(**given))
    print(json.dumps(result, default=str))


if __name__ == "__main__":
    main()
