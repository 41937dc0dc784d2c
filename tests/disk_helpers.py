"""What a build leaves on the disks, for the tests of it."""

import time

from pacelake.plans import views


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {x for x in files.split("\n") if "/shuffle_" in x}


def gone(spark, before, seconds=20):
    """Whether no other shuffle file than before is left within some seconds."""
    for _ in range(seconds * 5):
        if not shuffle_files(spark) - before:
            return True
        time.sleep(0.2)
    return False


def joins_of(monkeypatch):
    """The joins of the enriched rows, as builds make them from now on."""
    seen, made = [], views.results_enriched
    monkeypatch.setattr(views, "results_enriched", lambda *a, **kw: seen.append(made(*a, **kw)) or seen[-1])
    return seen
