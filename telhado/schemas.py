"""Table layouts of the bronze, silver and gold layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

PRICE = "preco_R$"

# Source field names -> table column names.
DETAIL_FIELDS = {
    "price": PRICE,
    "size": "area_m2",
    "rooms": "n_quartos",
    "bathrooms": "n_banheiros",
    "garage_spaces": "n_vagas_garagem",
}
ADDRESS_FIELDS = {
    "address": "endereco",
    "neighbourhood": "bairro",
    "municipality": "municipio",
    "zipcode": "cep",
    "uf": "UF",
}
RECORD_FIELDS = {**DETAIL_FIELDS, **ADDRESS_FIELDS}
NUMERIC_COLUMNS = list(DETAIL_FIELDS.values())
RECORD_COLUMNS = list(RECORD_FIELDS.values())

ADS = T.StructType([T.StructField(c, T.StringType()) for c in ["url", "titulos", *RECORD_COLUMNS]])
COORDS = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
    ]
)
ADS_WITH_COORDS = T.StructType(ADS.fields + COORDS.fields[1:])


def col(name: str) -> Column:
    """Column by literal name, also where the name holds `$` or a dot."""
    return F.col(f"`{name}`")


def ensure_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add the columns of `schema` that `df` lacks, as typed NULLs."""
    missing = {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in df.columns}
    return df.withColumns(missing) if missing else df
