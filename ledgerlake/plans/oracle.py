"""DuckDB SQL text for the oracle statements.

Each oracle is a single statement: the generator is inlined as a chain of
CTEs (one mixing step per CTE, mirroring the Spark projections) and every
query selects from it. Only used for verification; never on the Spark path.
"""

from __future__ import annotations

from ledgerlake import model
from ledgerlake.functions import draws as D


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v) for v in values) + "]"


def movements_ctes(
    name: str,
    source: str,
    index_col: str = "i",
    seed: int = 42,
    labels: str = "ascii",
    start_date: str = model.START_DATE,
    days: int = model.DATE_RANGE_DAYS,
    id_offset: int = 0,
    extra_draws: tuple[int, ...] = (),
    keep: tuple[str, ...] = (),
) -> list[str]:
    """CTEs ending in ``name`` with the columns of ``generate.movements``."""
    products = model.PRODUCTS if labels == "ascii" else model.PRODUCTS_ACCENTED
    types = model.OPERATION_TYPES if labels == "ascii" else model.OPERATION_TYPES_ACCENTED
    src = f"{name}_src"
    ctes = [f"{src} AS (SELECT CAST({index_col} AS BIGINT) AS {index_col}{''.join(', ' + k for k in keep)} FROM {source})"]
    ctes += D.sql_hash_ctes(name, src, index_col, seed, D.MOVEMENT_DRAWS + tuple(extra_draws))
    los = _list([b[0] for b in model.AMOUNT_BOUNDS_CENTS])
    his = _list([b[1] for b in model.AMOUNT_BOUNDS_CENTS])
    ctes.append(
        f"{name}_t AS (SELECT *, {index_col} + {1 + id_offset} AS mouvement_no, "
        f"{D.sql_pick('h3', len(types))} AS type_ord FROM {name}_h)"
    )
    ctes.append(
        f"{name}_c AS (SELECT *, {los}[type_ord + 1] + {D.sql_pick('h4', f'({his}[type_ord + 1] - {los}[type_ord + 1] + 1)')} AS cents FROM {name}_t)"
    )
    extra = "".join(f", h{c}" for c in extra_draws) + "".join(f", {k}" for k in keep)
    ctes.append(
        f"{name} AS (SELECT mouvement_no, printf('{model.ID_FORMAT}', mouvement_no) AS id_mouvement, "
        f"CAST(DATE '{start_date}' + CAST({D.sql_pick('h1', days)} AS INTEGER) AS DATE) AS date_op, "
        f"{_list(products)}[{D.sql_pick('h2', len(products))} + 1] AS produit, "
        f"{_list(types)}[type_ord + 1] AS type_op, type_ord, cents, "
        f"CAST(cents AS DOUBLE) / 100.0 AS montant, "
        f"printf('{model.AGENCY_FORMAT}', {D.sql_pick('h5', model.AGENCY_COUNT)} + 1) AS agence_id, "
        f"{_list(model.COUNTRIES)}[{D.sql_pick('h6', len(model.COUNTRIES))} + 1] AS pays{extra} "
        f"FROM {name}_c)"
    )
    return ctes


def orders_movements(name: str = "mv", **kw) -> list[str]:
    return movements_ctes(name, "(SELECT o_orderkey AS i FROM orders)", **kw)


def rules_cte(name: str = "rules") -> str:
    return (
        f"{name} AS (SELECT CAST(type_ord AS BIGINT) AS type_ord, type_op, type_op_accented, "
        f"CAST(lo_cents AS BIGINT) AS lo_cents, CAST(hi_cents AS BIGINT) AS hi_cents "
        f"FROM {model.values_sql(model.rule_rows(), model.RULE_COLUMNS)})"
    )


def with_(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body
