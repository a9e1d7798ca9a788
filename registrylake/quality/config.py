"""What each table promises: keys, required columns, references, plausible size."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class TableRules:
    pk: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    id_cols: tuple[str, ...] = ()
    date_cols: tuple[str, ...] = ()
    bool_cols: tuple[str, ...] = ()
    fk: tuple[tuple[str, str, str], ...] = ()  # column, parent table, parent key
    count_range: tuple[int, int, str] | None = None
    expected_columns: tuple[str, ...] = ()
    cardinality: tuple[tuple[str, int], ...] = ()  # column, largest group allowed
    key_column: str | None = None
    dtypes: tuple[tuple[str, str], ...] = ()  # column, Spark type name
    orphans: bool = False  # count orphans of the references too
    names: tuple[tuple[str, str], ...] = ()  # name, its identifier
    cross_refs: tuple[tuple[str, str, str, str], ...] = ()  # key, field, table of current rows, field there


WELL = (("api10", "well_master", "api10"),)


def text(*columns: str) -> tuple[tuple[str, str], ...]:
    return tuple((c, "string") for c in columns)



# The rules of the published tables.
TABLE_RULES: dict[str, TableRules] = {
    "well_master": TableRules(
        pk=("api10",),
        required=("api10", "apinum"),
        id_cols=("api10", "apinum"),
        count_range=(1_000_000, 1_500_000, "wells"),
        expected_columns=("api10", "apinum"),
        dtypes=text("api10", "apinum"),
        key_column="api10",
    ),
    "fact_well_completions": TableRules(
        pk=("api10", "gas_rrcid"),
        required=("api10", "gas_rrcid"),
        id_cols=("api10",),
        fk=WELL,
        expected_columns=("api10", "gas_rrcid"),
        dtypes=text("api10", "gas_rrcid"),
        cardinality=(("api10", 1000),),
        orphans=True,
        key_column="api10",
    ),
    "fact_production_monthly": TableRules(
        required=("district", "lease_number", "rpt_cycle_key"),
        id_cols=("district", "lease_number"),
        count_range=(1_500_000, 2_000_000, "production rows"),
    ),
    "fact_inspections": TableRules(required=("api10",), id_cols=("api10",), fk=WELL),
    "dim_operator_registry": TableRules(
        pk=("operator_number",),
        required=("operator_number",),
        id_cols=("operator_number",),
        count_range=(30_000, 80_000, "operators"),
        expected_columns=("operator_number", "operator_name"),
        names=(("operator_name", "operator_number"),),
    ),
    "dim_operator_history": TableRules(
        required=("api10", "operator_name"), id_cols=("api10",), bool_cols=("is_current",), fk=WELL, orphans=True,
        cross_refs=(("api10", "api10", "well_master", "api10"),),
    ),
    "dim_drilling_permits": TableRules(required=("api10",), id_cols=("api10",), fk=WELL),
    "dim_hearings": TableRules(required=("record_type",)),
    "dim_well_lease_crosswalk": TableRules(
        required=("api10", "lease_name"), id_cols=("api10",), bool_cols=("is_current",), fk=WELL
    ),
    "dim_lease_well_bridge": TableRules(
        pk=("district", "lease_number", "api10"),
        required=("district", "lease_number", "api10"),
        id_cols=("district", "lease_number", "api10"),
        fk=WELL,
    ),
    "fact_well_production_monthly": TableRules(pk=("api10", "month"), required=("api10",), id_cols=("api10",), fk=WELL),
    "dim_operator_consolidation": TableRules(required=("operator_number",), id_cols=("operator_number",)),
}


def rules_for(slug: str) -> TableRules:
    return TABLE_RULES.get(slug, TableRules())
