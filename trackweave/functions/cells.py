"""Square grid cells: the blocking of spatial joins and the base of point ids.

A cell packs column and row into 52 bits (26 each, shifted to be positive). `ring` lists a cell and its
eight neighbours; cells of one of four `colours` never touch each other.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OFFSET = 1 << 25
SIZE = 4.0


def cell(x: str, y: str, size: float = SIZE, dx: str = "0", dy: str = "0") -> str:
    i, j = f"(cast(floor({x} / {size}D) AS bigint) + {OFFSET} + {dx})", f"(cast(floor({y} / {size}D) AS bigint) + {OFFSET} + {dy})"
    return f"({i} * {1 << 26} + {j})"


def ring(x: str, y: str, size: float = SIZE) -> Column:
    return F.expr(f"flatten(transform(sequence(-1, 1), dx -> transform(sequence(-1, 1), dy -> {cell(x, y, size, 'dx', 'dy')})))")


def colour(cell_column: str) -> Column:
    return F.expr(f"cast(({cell_column} div {1 << 26}) % 2 * 2 + {cell_column} % 2 AS int)")
