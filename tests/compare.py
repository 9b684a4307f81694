"""Rows of two results, comparable whatever their order and number types."""

import numpy as np
import pandas as pd


def plain(value):
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and value != value):
        return None
    if isinstance(value, (bool, np.bool_)):
        return bool(value)
    if isinstance(value, (int, np.integer, float, np.floating)):
        return float(f"{float(value):.9g}")
    if isinstance(value, np.ndarray) or (isinstance(value, (list, tuple)) and not hasattr(value, "asDict")):
        return [plain(x) for x in value]
    if hasattr(value, "asDict"):
        value = value.asDict()
    if isinstance(value, dict):
        return {k: plain(x) for k, x in sorted(value.items())}
    return str(value)


def rows(frame: pd.DataFrame) -> list[str]:
    frame = frame[sorted(frame.columns)]
    return sorted(repr([plain(v) for v in row]) for row in frame.itertuples(index=False))


TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
    return con
