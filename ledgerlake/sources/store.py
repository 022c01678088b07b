"""Materialised ledger: the journal and its roll-ups, each written at its first use.

A table is derived and written as Parquet when a query first reads it, and read back
from then on, so a query pays for the tables it needs and no others.  The journal is
written as entries, one per line item with the codes and amounts of its legs, in order of
time (row-group and page statistics prune period filters); its readers expand them into
the legs, so what all legs of an entry share is written and read once.  The roll-ups are built from the monthly postings, the sums of
the same legs by spine key and period, which are far smaller than the journal.
Tables live in the shared folder named by ``spark.checkpoint.dir``.

Each table is a commit (``commits.once``): two processes that make one at the same
time each finish a folder of their own, one of them is committed, and readers only
ever follow the commit to a complete table.
"""

from __future__ import annotations

import hashlib
import threading
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed
from ..operators import rollups
from ..session import shared_dir
from . import adapter, subledgers
from .commits import once

LAYOUT_VERSION = "v15"
TABLES = ("journal", "accmast", "glcal", "glfis", "deptmast", "coacmast", "parthist")


@dataclass
class Ledger:
    """The ledger tables of one source directory, as DataFrames read from Parquet."""

    spark: SparkSession
    sf_dir: str
    root: str
    build_seconds: dict = field(default_factory=dict)
    _tables: dict = field(default_factory=dict)
    _latest: int | None = None
    _lock: threading.RLock = field(default_factory=threading.RLock)

    def path(self, name: str) -> str:
        """The folder of a table, which is made first if it is not there yet."""
        def write(path: str) -> None:
            t = time.time()
            w = MAKERS[name](self).write
            (w.partitionBy(PARTITIONED[name]) if name in PARTITIONED else w).parquet(path)
            self.build_seconds[name] = time.time() - t
        with self._lock:  # one build per process even when queries are started from threads
            return once(self.spark, f"{self.root}/{name}", write)

    def table(self, name: str) -> DataFrame:
        with self._lock:
            if name not in self._tables:
                stored = self.spark.read.parquet(self.path(name))
                self._tables[name] = READERS[name](stored) if name in READERS else stored
            return self._tables[name]

    @property
    def monthly(self) -> DataFrame:
        return self.table("monthly")

    @property
    def journal(self) -> DataFrame:
        return self.table("journal")

    @property
    def accmast(self) -> DataFrame:
        return self.table("accmast")

    @property
    def glcal(self) -> DataFrame:
        return self.table("glcal")

    @property
    def glfis(self) -> DataFrame:
        return self.table("glfis")

    @property
    def deptmast(self) -> DataFrame:
        return self.table("deptmast")

    @property
    def coacmast(self) -> DataFrame:
        return self.table("coacmast")

    @property
    def parthist(self) -> DataFrame:
        return self.table("parthist")

    @property
    def latest_period(self) -> int:
        """The newest period of the journal."""
        if self._latest is None:
            self._latest = int(self.monthly.agg(F.max("period")).first()[0])
        return self._latest

    def register_views(self, names=TABLES) -> None:
        """Expose the tables to ``spark.sql`` (FS48 ad-hoc queries)."""
        for t in names:
            self.table(t).createOrReplaceTempView(t)


#: How each table is derived from the source tables or from those before it.
MAKERS = {
    "monthly": lambda led: adapter.derive_monthly(led.spark, led.sf_dir),
    "journal": lambda led: adapter.derive_entries(led.spark, led.sf_dir),
    "accmast": lambda led: adapter.derive_accmast(led.monthly).coalesce(1),
    # GLCAL is partitioned by period: single-period reports (income statement, trial
    # balance, balance sheet) read one folder.
    "glcal": lambda led: rollups.build_glcal(led.monthly, led.accmast).hint("rebalance", "GB_DATE").sortWithinPartitions("GB_DATE", "GB_GLA"),
    "glfis": lambda led: rollups.build_glfis(led.glcal),
    "deptmast": lambda led: rollups.build_deptmast(led.glcal),
    "coacmast": lambda led: rollups.build_coacmast(rollups.build_balances(led.monthly, led.accmast, latest_period=led.latest_period)),
    "parthist": lambda led: subledgers.parts_history(led.spark, led.sf_dir),
}
PARTITIONED = {"glcal": "GB_DATE"}
#: What readers get of a table that is stored in another shape.
READERS = {"journal": adapter.journal_from_entries}

_CACHE: dict[tuple[str, str], Ledger] = {}
_LOCK = threading.Lock()


def _stamp(spark: SparkSession, sf_dir: str) -> str:
    """Names, sizes and modification times of the source files: a ledger is of the
    files it was built from, so new or changed rows lead to another one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())

    def files(p, depth: int):
        for s in fs.listStatus(p):
            if s.isDirectory():
                yield from files(s.getPath(), depth + 1)
            else:  # with the folders above it: a partition value is part of the data
                names = str(s.getPath()).rsplit("/", depth + 1)[1:]
                yield f"{'/'.join(names)}:{s.getLen()}:{s.getModificationTime()}"
    return ",".join(sorted(files(path, 0)))


def _root(spark: SparkSession, sf_dir: str) -> str:
    tag = hashlib.sha1(f"{sf_dir.rstrip('/')}|{LAYOUT_VERSION}|{fixed.LAST_CLOSE}|{_stamp(spark, sf_dir)}".encode()).hexdigest()[:16]
    return f"{shared_dir(spark)}/ledgerlake/{tag}"


def source_root(spark: SparkSession, sf_dir: str) -> str:
    """The folder of everything that is derived from the files now in ``sf_dir``."""
    return _root(spark, sf_dir)


def ledger(spark: SparkSession, sf_dir: str, rebuild: bool = False) -> Ledger:
    """The ledger for ``sf_dir``; ``rebuild`` derives every table anew, at once, for this process."""
    root = _root(spark, sf_dir)
    key = (spark.conf.get("spark.app.id", None) or str(id(spark)), root)
    with _LOCK:
        if rebuild or key not in _CACHE:
            _CACHE[key] = Ledger(spark, sf_dir, f"{root}/b-{uuid.uuid4().hex}" if rebuild else root)
        led = _CACHE[key]
    if rebuild:
        for t in TABLES:
            led.path(t)
    return led
