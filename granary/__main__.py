"""python -m granary QUERY --data FOLDER [--out FOLDER]: runs a query of the catalogue and shows or writes its rows."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession


def main(arguments: list[str] | None = None) -> None:
    from granary.plans import branches, catalogue  # noqa: F401 - branches adds its queries to the catalogue

    known = catalogue.queries()
    parser = argparse.ArgumentParser(prog="granary", description=__doc__)
    parser.add_argument("query", choices=sorted(known), metavar="QUERY")
    parser.add_argument("--data", required=True, help="folder of the parquet tables")
    parser.add_argument("--out", help="folder for the result; without it, 20 rows are shown")
    given = parser.parse_args(arguments)
    result = known[given.query](SparkSession.builder.getOrCreate(), given.data)
    if given.out:
        result.write.mode("overwrite").parquet(given.out)
    else:
        result.show(20, truncate=120)


if __name__ == "__main__":
    main()
