"""DDL text -> classified sub-changes, with column expressions only.

Steps: normalise (lower case, back-quotes removed, blanks collapsed, leading
comments, closing semicolons and column comments stripped); classify the statement; cut an ALTER body into clauses
with a pattern that keeps commas inside parentheses and quotes (so
``decimal(10,2)``, ``primary key (a,b)`` and ``default '1,5'`` stay whole);
classify every clause and extract the names it touches.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns of the classification (lower-cased input).
QUOTED = r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*\""""
REMARKS = r"^(?:\s+|/\*(?!!)(?s:.*?)\*/|--[ \t][^\n]*(?:\n|$)|#[^\n]*(?:\n|$))+"
IF_EXISTS = "(?:if (?:not )?exists )?"
COMMENT = f" ?comment ?=? ?(?:{QUOTED})"
INNER = f"(?:[^()'\"]|{QUOTED}|\\((?:[^()'\"]|{QUOTED})*\\))*"  # of parentheses, with one level of others in it
CLAUSE = f"(?:[^,('\"]|\\({INNER}\\)|{QUOTED})+"
COLUMN_LIST = "^add (?:column )?\\((.*)\\)$"
TARGET = f"^(?:alter|truncate|drop|create|rename) table {IF_EXISTS}([^ ]+)"
ALTER_BODY = f"^alter table {IF_EXISTS}[^ ]+ ?(.*)$"
RENAME_BODY = f"^rename table {IF_EXISTS}(.*)$"
KEY_LIST = r"primary key ?(?:using [a-z]+ ?)?\(((?:[^()]|\([^()]*\))*)\)"
KEY_PART = r" ?\([^()]*\)| (?:asc|desc)$"  # of a key column: the prefix it is cut to, its direction

# (kind, pattern) in order: the first match wins.
STATEMENT_KINDS = [
    ("truncate", "^truncate (table )?[^ ]+"),
    ("drop_table", "^drop table "),
    ("rename_tables", "^rename table "),
    ("alter", f"^alter table {IF_EXISTS}[^ ]+( |$)"),
    ("create", "^create table "),
]

CLAUSE_KINDS = [
    ("rename_column", f"^rename column {IF_EXISTS}[^ ]+ to [^ ]+"),
    ("noop", "^rename (index|key) "),
    ("rename_table", "^rename (to |as )?[^ ]+$"),
    ("add_key", "^add (constraint [^ ]+ )?primary key"),
    ("drop_key", "^drop primary key"),
    ("noop", "^(add|drop|reorganize|truncate|coalesce|exchange|analyze|check|optimize|rebuild|repair|discard|import|remove) partition(ing)?( |$)"),
    ("noop", "^drop (foreign key|index|key|constraint|check) "),
    ("drop_column", f"^drop (column )?{IF_EXISTS}[^ ]+"),
    ("change_column", f"^change (column )?{IF_EXISTS}[^ ]+ [^ ]+"),
    ("modify_column", "^modify "),
    ("noop", "^add (index|unique|key|fulltext|spatial|foreign|constraint|check)( |\\()"),
    ("add_column", "^add "),
    ("noop", "^(auto_increment|engine|default|charset|character set|collate|comment|partition|convert|row_format|algorithm|lock|force|order by)"),
]


def normalise(ddl: Column) -> Column:
    s = F.regexp_replace(F.lower(ddl), REMARKS, "")
    s = F.regexp_replace(s, "`", "")
    s = F.regexp_replace(F.regexp_replace(s, "\\s+", " "), "[ ;]+$", "")
    return F.trim(F.regexp_replace(s, COMMENT, ""))


def _first_match(s: Column, table: list[tuple[str, str]], default: str) -> Column:
    out = None
    for kind, pat in table:
        out = (F.when(s.rlike(pat), F.lit(kind)) if out is None else out.when(s.rlike(pat), F.lit(kind)))
    return out.otherwise(F.lit(default))


def statement_kind(norm: Column) -> Column:
    return _first_match(norm, STATEMENT_KINDS, "unknown")


def clauses(norm: Column, kind: Column) -> Column:
    """Sub-change texts of a statement (ALTER clauses, RENAME TABLE pairs)."""
    body = F.when(kind == "alter", F.regexp_extract(norm, ALTER_BODY, 1)).when(kind == "rename_tables", F.regexp_extract(norm, RENAME_BODY, 1))
    parts = F.flatten(F.transform(_cut(body), lambda x: F.when(x.rlike(COLUMN_LIST), _added(x)).otherwise(F.array(x))))
    # nothing is left of an ALTER that only sets the table's comment
    return F.when(body.isNull(), F.array(norm)).when(F.size(parts) == 0, F.array(F.lit("comment"))).otherwise(parts)


def _cut(text: Column) -> Column:
    return F.filter(F.transform(F.regexp_extract_all(text, F.lit(CLAUSE), 0), lambda x: F.trim(x)), lambda x: x != "")


def _added(clause: Column) -> Column:
    """One ADD clause for each column of a list in parentheses."""
    return F.transform(_cut(F.regexp_extract(clause, COLUMN_LIST, 1)), lambda x: F.concat(F.lit("add column "), x))


def clause_kind(stmt_kind: Column, clause: Column) -> Column:
    return (
        F.when(stmt_kind == "alter", _first_match(clause, CLAUSE_KINDS, "unknown"))
        .when(stmt_kind == "rename_tables", F.when(clause.rlike("^[^ ]+ to [^ ]+$"), "rename_table").otherwise("unknown"))
        .otherwise(stmt_kind)
    )


def clause_names(stmt_kind: Column, kind: Column, clause: Column, target: Column) -> tuple[Column, Column]:
    """``(old_name, new_name)`` a clause touches (table or column names)."""
    pair = "^([^ ]+) to ([^ ]+)$"
    change = f"^change (?:column )?{IF_EXISTS}([^ ]+) ([^ ]+)"
    old = (
        F.when(stmt_kind == "rename_tables", F.regexp_extract(clause, pair, 1))
        .when(kind == "rename_table", target)
        .when(kind == "rename_column", F.regexp_extract(clause, f"^rename column {IF_EXISTS}([^ ]+) to", 1))
        .when(kind == "drop_column", F.regexp_extract(clause, f"^drop (?:column )?{IF_EXISTS}([^ ]+)", 1))
        .when(kind == "change_column", F.regexp_extract(clause, change, 1))
        .when(kind.isin("modify_column"), F.regexp_extract(clause, f"^modify (?:column )?{IF_EXISTS}([^ ]+)", 1))
        .when(kind.isin("add_column"), F.regexp_extract(clause, f"^add (?:column )?{IF_EXISTS}([^ ]+)", 1))
        .when(kind.isin("truncate", "drop_table", "create"), target)
    )
    new = (
        F.when(stmt_kind == "rename_tables", F.regexp_extract(clause, pair, 2))
        .when(kind == "rename_table", F.regexp_extract(clause, "^rename (?:to |as )?([^ ]+)$", 1))
        .when(kind == "rename_column", F.regexp_extract(clause, "to ([^ ]+)$", 1))
        .when(kind == "change_column", F.regexp_extract(clause, change, 2))
    )
    return old, new


def key_list(clause: Column) -> Column:
    """Key columns of an ADD PRIMARY KEY clause, comma-joined, without prefix lengths; null if it names none."""
    raw = F.regexp_extract(clause, KEY_LIST, 1)
    names = F.transform(F.split(F.regexp_replace(raw, "\\([^()]*\\)", ""), ","), lambda x: F.trim(F.regexp_replace(F.trim(x), KEY_PART, "")))
    return F.nullif(F.array_join(F.filter(names, lambda x: x != ""), ","), F.lit(""))
