"""Set-based statements that take staged rows on to a table of a relational target."""

from __future__ import annotations

#: How a dialect quotes names.
QUOTES = {"ansi": ('"', '"'), "mysql": ("`", "`")}


def quoted(name: str, dialect: str = "ansi") -> str:
    a, b = QUOTES[dialect]
    return a + name.replace(b, b + b) + b


def table_name(name: str, dialect: str) -> str:
    return ".".join(quoted(x, dialect) for x in name.split("."))


def upsert(stage: str, target: str, keys: list[str], values: list[str], dialect: str = "ansi", has: str | None = None) -> str:
    """One statement that inserts staged rows with new keys and updates the others.

    ``has``: suffix of flag columns of the stage (``status_has``); a value without its flag stays as the target
    has it, and an explicit null is a value. A table of keys alone inserts what is missing.
    """
    q = lambda n: quoted(n, dialect)
    cols, s, t = [*keys, *values], table_name(stage, dialect), table_name(target, dialect)
    names = ", ".join(map(q, cols))
    if dialect == "mysql":
        flag = lambda v: f"IF(s.{q(v + has)}, s.{q(v)}, t.{q(v)})" if has else f"s.{q(v)}"
        sets = ", ".join(f"{q(v)} = {flag(v)}" for v in values) or f"{q(keys[0])} = t.{q(keys[0])}"
        return f"INSERT INTO {t} AS t ({names}) SELECT {', '.join('s.' + q(c) for c in cols)} FROM {s} AS s ON DUPLICATE KEY UPDATE {sets}"
    on = " AND ".join(f"t.{q(k)} = s.{q(k)}" for k in keys)
    flag = lambda v: f"CASE WHEN s.{q(v + has)} THEN s.{q(v)} ELSE t.{q(v)} END" if has else f"s.{q(v)}"
    change = f" WHEN MATCHED THEN UPDATE SET {', '.join(f'{q(v)} = {flag(v)}' for v in values)}" if values else ""
    return f"MERGE INTO {t} AS t USING {s} AS s ON ({on}){change} WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({', '.join('s.' + q(c) for c in cols)})"


def delete(stage: str, target: str, keys: list[str], dialect: str = "ansi") -> str:
    """One statement that deletes the staged keys."""
    q = lambda n: quoted(n, dialect)
    on = " AND ".join(f"t.{q(k)} = s.{q(k)}" for k in keys)
    s, t = table_name(stage, dialect), table_name(target, dialect)
    if dialect == "mysql":
        return f"DELETE t FROM {t} AS t JOIN {s} AS s ON {on}"
    return f"DELETE FROM {t} AS t WHERE EXISTS (SELECT 1 FROM {s} AS s WHERE {on})"


def insert(stage: str, target: str, columns: list[str], dialect: str = "ansi") -> str:
    """One statement that loads staged rows into an empty or keyless table."""
    names = ", ".join(quoted(c, dialect) for c in columns)
    return f"INSERT INTO {table_name(target, dialect)} ({names}) SELECT {names} FROM {table_name(stage, dialect)}"
