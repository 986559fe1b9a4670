"""Run every registered query against its SQL: python tests/check_oracles.py [folder] [names...]

Arguments with "=" are Spark settings, to check other physical plans or time zones.
"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from tests.oracle import connect, difference  # noqa: E402
from tidegauge.session import spark_session  # noqa: E402

plain = [a for a in sys.argv[1:] if "=" not in a]
settings = dict(a.split("=", 1) for a in sys.argv[1:] if "=" in a)
folder = plain[0] if plain else "/root/testdata/sf0.01"
chosen = plain[1:]
spark = spark_session(
    master="local[8]", spark_sql_shuffle_partitions="8", spark_ui_enabled="false",
    spark_driver_memory="12g", spark_ui_showConsoleProgress="false",
)
spark.sparkContext.setLogLevel("ERROR")
for key, value in settings.items():
    spark.conf.set(key, value)
con = connect(folder)
oracles = entry.oracle_sql()
failed = []
for name, run in entry.queries().items():
    if chosen and name not in chosen:
        continue
    started = time.time()
    try:
        if name in oracles:
            problem = difference(run(spark, folder), con, oracles[name])
        else:
            problem = None if run(spark, folder).count() else "no rows"
    except Exception as error:
        problem = f"{type(error).__name__}: {str(error)[:600]}"
    print(f"{'ok  ' if problem is None else 'FAIL'} {name:34s} {time.time() - started:6.2f}s {problem or ''}", flush=True)
    if problem:
        failed.append(name)
print("failed:", failed)
print("without SQL:", [n for n in entry.queries() if n not in oracles])
