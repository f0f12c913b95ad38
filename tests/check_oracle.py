"""Run queries against their SQL: `python tests/check_oracle.py [sf_dir] [key ...]`."""

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parent.parent), str(Path(__file__).resolve().parent)]

import __spark_entry__ as entry  # noqa: E402
from compare import connect, differences  # noqa: E402
from skyledger.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        "check", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g",
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls = connect(sf_dir), entry.oracle_sql()
    wanted = sys.argv[2:] or list(entry.queries())
    failed = []
    for key in wanted:
        start = time.monotonic()
        try:
            df = entry.queries()[key](spark, sf_dir)
            if key in sqls:
                found = differences(df, con, sqls[key])
                verdict = "equal" if not found else "DIFFERS"
            else:
                found, verdict = [], f"{df.count()} rows, no SQL"
        except Exception as error:  # report and go on with the next query
            found, verdict = [f"{type(error).__name__}: {str(error)[:1500]}"], "FAILED"
        failed += [key] if found else []
        print(f"{key:32s} {verdict:20s} {time.monotonic() - start:6.1f} s", flush=True)
        for line in found:
            print("   ", line[:1500])
    print("all equal" if not failed else f"not equal: {failed}")
    spark.stop()


if __name__ == "__main__":
    main()
