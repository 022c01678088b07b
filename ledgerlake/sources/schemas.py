"""Fixed schemas of the ledger tables (one StructType each) and their key lists."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
I = T.IntegerType()
L = T.LongType()
MONEY = T.DecimalType(18, 2)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


CHART = _struct(
    ("ACSTA", S), ("ACACC", S), ("ACNME", S), ("ACTYP", S), ("ACLIA", S), ("ACMEM", S), ("ACCT", S),
)

ACCMAST = _struct(
    ("ACSTA", S), ("ACCO", S), ("ACACC", S), ("ACNME", S), ("ACTYP", S), ("ACLIA", S), ("ACMEM", S),
    ("ACCT", S), ("ACLT", S), ("ACGRP", S), ("AC_MCR", S), ("AC_ET", S), ("AC_FILA", S),
)

YTDJRL = _struct(
    ("YJ_CO", S), ("YJ_DIV", S), ("YJ_JRL", S), ("YJ_CC", S), ("YJ_ACC", S),
    ("YJ_AMT", T.DecimalType(12, 2)), ("YJ_OSJ", S), ("YJ_RDT", I), ("YJ_RJRL", S), ("YJ_UID", L),
    ("YJ_PDT", I), ("YJ_DT", I), ("YJ_MEM", S), ("YJ_SRC", S), ("YJ_STA", S), ("YJ_RID", S),
    ("YJ_USE", S), ("YJ_CRT", S), ("YJ_DES", S), ("leg", I), ("period", I),
)

GLCAL = _struct(
    ("GB_STA", S), ("GB_CO", S), ("GB_DIV", S), ("GB_GLC", S), ("GB_GLA", S), ("GB_DATE", I),
    ("GB_AMT", MONEY), ("GB_YE", S),
)

GLFIS = _struct(
    ("GF_STA", S), ("GF_CO", S), ("GF_DIV", S), ("GF_GLC", S), ("GF_GLA", S), ("GF_YR", I),
    *[(f"GF_H{m}", MONEY) for m in range(1, 13)],
)

DEPTMAST = _struct(
    ("DP_CO", S), ("DP_DIV", S), ("DP_CC", S), ("DP_ACC", S),
    *[(f"DP_C{m}", MONEY) for m in range(1, 13)],
    *[(f"DP_L{m}", MONEY) for m in range(1, 13)],
    ("DP_AL", S), ("DP_GRP", S), ("DP_STA", S), ("DP_FILB", S),
)

# Key lists: spine keys of each table in (company, division, cost center, account) order.
JOURNAL_KEY = ["YJ_CO", "YJ_DIV", "YJ_CC", "YJ_ACC"]
GLCAL_KEY = ["GB_CO", "GB_DIV", "GB_GLC", "GB_GLA"]
GLFIS_KEY = ["GF_CO", "GF_DIV", "GF_GLC", "GF_GLA"]
DEPT_KEY = ["DP_CO", "DP_DIV", "DP_CC", "DP_ACC"]
COA_KEY = ["CA_CO", "CA_DIV", "CA_CC", "CA_ACC"]
ACC_KEY = ["ACCO", "ACACC"]

# Run log (AcctLoadControl, deployed shape, without credential columns).
LOAD_CONTROL = _struct(
    ("RunId", S), ("TableName", S), ("RunKind", S), ("Status", S),
    ("StartedUtc", T.TimestampType()), ("EndedUtc", T.TimestampType()),
    ("RowsCopied", L), ("RowsInserted", L), ("RowsUpdated", L), ("RowsMerged", L),
    ("WatermarkFrom", L), ("WatermarkTo", L), ("ErrorMessage", S),
)

# Snapshot watermark store (AcctSnapshotControl).
SNAPSHOT_CONTROL = _struct(
    ("TableName", S), ("LastCapturedThroughUtc", T.TimestampType()),
    ("LastSnapshotRunUtc", T.TimestampType()), ("LastRowsCaptured", L),
)
