"""Local correctness check: run registered Spark queries and their DuckDB oracles side by side.

``python -m devmetrics.plans.check [sf_dir] [name ...]`` prints one line per query: rows, schema and values.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


EXACT = True  # compare doubles bit for bit (the driver's value hash may not round)


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if EXACT else round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


_SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                  "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT", "date": "DATE"}


def spark_types(sdf) -> dict[str, str]:
    return {f.name: _SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema.fields}


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, sf_dir: str, names=None, verbose: bool = True) -> dict[str, str]:
    from devmetrics.plans.catalog import QUERIES
    from devmetrics.plans.oracle import ORACLE

    con = duck(sf_dir)
    results = {}
    for name in names or list(QUERIES):
        t0 = time.time()
        try:
            sdf = QUERIES[name](spark, sf_dir)
            srows = [tuple(r) for r in sdf.collect()]
            scols = sdf.columns
        except Exception as e:  # noqa: BLE001
            results[name] = f"SPARK-ERROR {type(e).__name__}: {str(e)[:300]}"
            if verbose:
                print(f"{name:32s} {results[name]}", flush=True)
            continue
        ts = time.time() - t0
        if name not in ORACLE:
            results[name] = f"rows-only {len(srows)}"
        else:
            try:
                rel = con.sql(ORACLE[name])
                dcols = rel.columns
                dtypes = {c: str(t) for c, t in zip(rel.columns, rel.types)}
                drows = rel.fetchall()
            except Exception as e:  # noqa: BLE001
                results[name] = f"DUCK-ERROR {str(e)[:300]}"
                if verbose:
                    print(f"{name:32s} {results[name]}", flush=True)
                continue
            sc, sr = rows_of(scols, srows)
            dc, dr = rows_of(dcols, drows)
            stypes = spark_types(sdf)
            if sc != dc:
                results[name] = f"SCHEMA spark={sc} duck={dc}"
            elif stypes != dtypes:
                diff = {c: (stypes[c], dtypes.get(c)) for c in stypes if stypes[c] != dtypes.get(c)}
                results[name] = f"TYPES differ {diff}"
            elif len(sr) != len(dr):
                results[name] = f"ROWCOUNT spark={len(sr)} duck={len(dr)}"
            elif sr != dr:
                diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
                results[name] = f"VALUES differ ({len(sr)} rows) e.g. {diff}"
            else:
                results[name] = f"OK {len(sr)} rows"
        if verbose:
            print(f"{name:32s} {results[name]}  ({ts:.1f}s)", flush=True)
    return results


def main(argv: list[str]) -> int:
    from devmetrics.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or None
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    res = compare(spark, sf_dir, names)
    bad = [n for n, r in res.items() if not (r.startswith("OK") or r.startswith("rows-only"))]
    print(f"{len(res) - len(bad)}/{len(res)} ok; failing: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
