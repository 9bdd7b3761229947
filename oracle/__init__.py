"""DuckDB SQL with the expected result of every deterministic operator."""

from oracle import demand, disruption, finance, star, stock

ORACLES: dict[str, str] = {
    **star.ORACLES, **finance.ORACLES, **demand.ORACLES, **stock.ORACLES,
    **disruption.ORACLES,
}
