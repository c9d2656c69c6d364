"""Small builders and a plain-Python sequential fold used as a test oracle."""

from __future__ import annotations

import random

from tidemark.schema import CHANGELOG

COLS = ["id", "a", "b", "c"]


def cell(name, value, key=False, updated=True, null=False):
    return {"name": name, "is_key": key, "updated": updated, "is_null": null, "value": None if null else value}


def random_log(n_events: int, n_keys: int, seed: int, sources=("db.t",), hot_key: int | None = None):
    """Random change rows (dicts in CHANGELOG shape) with unique seq."""
    rnd = random.Random(seed)
    seqs = rnd.sample(range(1, n_events * 10), n_events)
    rows = []
    for s in seqs:
        src = rnd.choice(sources)
        k = hot_key if hot_key is not None and rnd.random() < 0.4 else rnd.randrange(n_keys)
        r = rnd.random()
        if r < 0.03 and len(sources) > 0:
            rows.append(dict(source_key=src, database=src.split(".")[0], table=src.split(".")[1], exec_time=None,
                             op="TRUNCATE", ddl="truncate table t", seq=s, before=None, after=None))
            continue
        op = "INSERT" if r < 0.35 else ("UPDATE" if r < 0.8 else "DELETE")
        img = [cell("id", str(k), key=True, updated=(op == "INSERT"))]
        for c in COLS[1:]:
            if rnd.random() < 0.3:
                img.append(cell(c, None, null=True, updated=rnd.random() < 0.5))
            else:
                img.append(cell(c, f"{c}{rnd.randrange(5)}", updated=rnd.random() < 0.7))
        before, after = (img, None) if op == "DELETE" else (None, img)
        rows.append(dict(source_key=src, database=src.split(".")[0], table=src.split(".")[1], exec_time=None,
                         op=op, ddl=None, seq=s, before=before, after=after))
    return rows


def to_df(spark, rows):
    return spark.createDataFrame([tuple(r[f] for f in CHANGELOG.fieldNames()) for r in rows], CHANGELOG)


def sequential_fold(rows, connector="+", reverse=True):
    """Apply the log one change at a time in seq order (the reference's loop)."""
    state: dict[tuple[str, str], dict[str, str]] = {}

    def rk(src, img):
        keys = sorted((c["name"].lower(), c["value"] or "") for c in img if c["is_key"])
        if not keys:
            return None
        j = connector.join(v for _, v in keys)
        return (j[::-1] if reverse else j) + connector + src

    for ch in sorted(rows, key=lambda r: r["seq"]):
        src, op = ch["source_key"], ch["op"]
        if op in ("TRUNCATE", "ERASE"):
            for key in [k for k in state if k[0] == src]:
                del state[key]
        elif op in ("INSERT", "UPDATE"):
            key = rk(src, ch["after"])
            if key is None:
                continue
            row = state.setdefault((src, key), {})
            for c in ch["after"]:
                if not c["is_null"] and c["value"] is not None:
                    row[c["name"].lower()] = c["value"]
                elif op == "UPDATE" and c["updated"]:
                    row[c["name"].lower()] = ""
        elif op == "DELETE":
            key = rk(src, ch["before"])
            if key is not None:
                state.pop((src, key), None)
    return {k: v for k, v in state.items()}


def state_as_dict(df):
    return {(r["source_key"], r["row_key"]): dict(r["cells"]) for r in df.collect()}


def schema_log(r, n=70):
    """Row changes of tables whose names, keys and columns change, one of which loses its key."""
    keys = {"a": "id", "b": "id", "c": "id"}
    columns = {t: ["id", "k", "v"] for t in keys}
    rows, seq = [], 0

    def add(table, op, ddl=None, image=None):
        before, after = (image, None) if op == "DELETE" else (None, image)
        rows.append(dict(source_key=f"db.{table}", database="db", table=table, exec_time=None, op=op, ddl=ddl, seq=seq, before=before, after=after))

    for step in range(n):
        seq += r.randint(1, 9)
        t = r.choice(sorted(keys))
        if step % 9 == 8:
            kind = ["swap", "rekey", "column", "move", "drop", "rekey", "stop"][step // 9 % 7]
            other = next(x for x in sorted(keys) if x != t)
            if kind == "swap":
                add(t, "RENAME", f"rename table {t} to tmp, {other} to {t}, tmp to {other}")
                keys[t], keys[other], columns[t], columns[other] = keys[other], keys[t], columns[other], columns[t]
            elif kind == "rekey":
                keys[t] = "k" if keys[t] == "id" else "id"
                add(t, "ALTER", f"alter table {t} drop primary key, add primary key using btree ({keys[t]}(10))")
            elif kind == "column":
                new = f"v{step}"
                add(t, "ALTER", f"alter table {t} change {columns[t][2]} {new} text;")
                columns[t][2] = new
            elif kind == "move":
                add(t, "ALTER", f"alter table {t} rename to t{step}")
                keys[f"t{step}"], columns[f"t{step}"] = keys.pop(t), columns.pop(t)
            elif kind == "drop":
                add(t, "ERASE", f"drop table {t}")
                seq += 1
                add(other, "RENAME", f"rename table {other} to {t}")
                keys[t], columns[t] = keys.pop(other), columns.pop(other)
            else:
                add(t, "ALTER", f"alter table {t} drop primary key")
                del keys[t], columns[t]
            continue
        cells = [cell(c, str(r.randrange(4)) if c in ("id", "k") else f"x{step}", key=(c == keys[t])) for c in columns[t]]
        add(t, r.choice(["INSERT", "INSERT", "UPDATE", "DELETE"]), image=cells)
    return rows


def fold_schema_log(rows):
    """The log of ``schema_log`` one event at a time."""
    tables, stopped = {}, set()
    for ch in rows:
        t, words = ch["table"], (ch["ddl"] or "").rstrip(";").split()
        if ch["op"] in ("INSERT", "UPDATE", "DELETE"):
            image = ch["after"] or ch["before"]
            key = next(c["value"] for c in image if c["is_key"])
            if ch["op"] == "DELETE":
                tables.get(t, {}).pop(key, None)
            elif t not in stopped:
                row = tables.setdefault(t, {}).setdefault(key, ({}, 0))
                tables[t][key] = ({**row[0], **{c["name"]: c["value"] for c in image}}, ch["seq"])
        elif ch["op"] == "RENAME":
            for pair in ch["ddl"][len("rename table "):].split(", "):
                old, _, new = pair.split()
                tables[new] = tables.pop(old, {})
                stopped = {new if s == old else s for s in stopped}
        elif ch["op"] == "ERASE":
            tables.pop(t, None)
        elif "rename" in words:
            tables[words[-1]] = tables.pop(t, {})
        elif "change" in words:
            old, new = words[4:6]
            tables[t] = {k: ({(new if c == old else c): v for c, v in row.items()}, at) for k, (row, at) in tables.get(t, {}).items()}
        elif "add" in words:
            name = words[-1].strip("()").split("(")[0]
            made = {}
            for row, at in sorted(tables.get(t, {}).values(), key=lambda x: x[1]):
                k = row.get(name, "")
                made[k] = ({**made.get(k, ({}, 0))[0], **row}, at)
            tables[t] = made
        else:
            tables.pop(t, None)
            stopped.add(t)
    return {(f"db.{t}", f"{k[::-1]}+db.{t}"): row for t, held in tables.items() if t not in stopped for k, (row, _) in held.items()}
