"""Column names of our own that no caller's column has."""

from pyspark.sql import DataFrame


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Each name, with underscores in front until no column of ``df`` has it, whatever its case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


def quoted(*names: str) -> list[str]:
    """Names as references to top-level columns, whatever characters they hold."""
    return ["`" + n.replace("`", "``") + "`" for n in names]
