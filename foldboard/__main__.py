"""Runs one request, for ``spark-submit`` or ``python -m foldboard``.

    python -m foldboard request.json s3a://bucket [--output s3a://bucket]

``request.json`` holds ``key``, ``feature_cols``, ``label_col``, ``data_types``
and ``train_test_split``. The table lies at ``key`` below the given root; the
winner is saved below ``--output`` and the result document is printed.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from foldboard.plans.run import run_file
from foldboard.plans.spec import RunSpec


def main(arguments: list[str] | None = None) -> dict:
    parser = argparse.ArgumentParser(prog="foldboard", description="Train and compare regressors.")
    parser.add_argument("request", help="file with the JSON request")
    parser.add_argument("root", help="folder or bucket that the request's key is relative to")
    parser.add_argument("--output", help="where to save the winner; default: the root")
    parser.add_argument("--schema", help="column types as DDL, saves the pass that infers them")
    parser.add_argument("--parallelism", type=int, default=3, help="fits at the same time")
    options = parser.parse_args(arguments)
    with open(options.request, encoding="utf-8") as file:
        request = json.load(file)
    result = run_file(
        SparkSession.builder.appName("foldboard").getOrCreate(),
        f"{options.root.rstrip('/')}/{request['key'].lstrip('/')}",
        RunSpec.from_request(request),
        schema=options.schema,
        save_to=options.output or options.root,
        parallelism=options.parallelism,
    )
    document = result.document()
    print(json.dumps(document))
    return document


if __name__ == "__main__":
    main()
