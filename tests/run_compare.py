"""Run all registered queries against their SQL: run_compare.py FOLDER [NAME ...]."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry  # noqa: E402
from siltworks.session import local_session  # noqa: E402
from tests.compare import differences, sql_connection  # noqa: E402


def main(sf_dir: str, *names: str) -> int:
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    connection, sql, failed = sql_connection(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            if name in sql:
                problem = differences(query(spark, sf_dir), connection, sql[name])
            else:
                query(spark, sf_dir).write.format("noop").mode("overwrite").save()
                problem = None
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:400]}"
        failed += problem is not None
        print(f"{name:32} {time.time() - started:6.2f}s {problem or 'ok'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
