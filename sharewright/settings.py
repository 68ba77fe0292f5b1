"""Parameters of the plans. Every operator takes its parameters as arguments; these are the defaults."""
from __future__ import annotations

from dataclasses import dataclass, field
from types import MappingProxyType

# Spellings of product categories and their official form.
CATEGORY_SYNONYMS = {"CHOCOLATE": "CHOCOLATES", "LACTEO": "LACTEOS"}

# Product text columns kept in normal form.
PRODUCT_TEXT_COLUMNS = ("product_description", "brand", "manufacturer", "category", "subcategory", "package_unit")

# Official state codes.
STATES = (
    "AC", "AL", "AP", "AM", "BA", "CE", "DF", "ES", "GO", "MA", "MT", "MS", "MG", "PA",
    "PB", "PR", "PE", "PI", "RJ", "RN", "RS", "RO", "RR", "SC", "SP", "SE", "TO",
)

# Extreme points of the country (degrees).
COUNTRY_BOX = {"south": -33.751944, "north": 5.271944, "west": -73.990556, "east": -34.792778}

# Canonical column <- provider column, per provider file.
PROVIDERS = {
    "A": {
        "table": "fact_provider_a",
        "required": {
            "year_week": "week", "store_id": "store_id", "ean": "ean", "units": "units",
            "sales_value_brl": "sales_value_brl", "sold_volume": "sold_volume",
            "source_file": "source_file", "ingestion_ts": "ingestion_timestamp",
        },
        "optional": {"average_price": "average_price"},
        "legacy": {"sales_value": "sales_value_brl", "sales_volume": "sold_volume"},
    },
    "B": {
        "table": "fact_provider_b",
        "required": {
            "year_week": "reference_week", "store_id": "customer_code", "ean": "product_ean",
            "units": "unit_count", "sales_value_brl": "sales_value_brl", "sold_volume": "sold_volume",
            "source_file": "source_file", "ingestion_ts": "load_date",
        },
        "optional": {"competitor_flag": "competitor_flag", "market": "market"},
        "legacy": {"revenue": "sales_value_brl", "qty_kg": "sold_volume"},
    },
}

# Cut name -> columns of the cell.
CUTS = {
    "NACIONAL": (),
    "REDE": ("retailer_name",),
    "CANAL": ("channel",),
    "UF": ("state",),
    "TERRITORIO": ("territory_id",),
}

# Columns that must never be published.
FORBIDDEN_COLUMNS = ("contact_name", "contact_email", "contact_phone", "cnpj", "latitude", "longitude")

# Fixed value: label of a sale without any territory.
NO_TERRITORY = "SEM_TERRITORIO"

# Who resolves a removed fact row (labels are fixed values), and what they should do (text is ours).
REMOVAL_ACTIONS = {
    "FCT_001": ("Nothing: identical copy discarded", "-"),
    "FCT_002": ("Provider to say which version is valid", "FORNECEDOR"),
    "FCT_003": ("Decide which provider has precedence for the store", "NEGOCIO"),
    "FCT_004": ("Fix the store code or register the store", "FORNECEDOR / CADASTRO"),
    "FCT_005": ("Register the product code or fix it at the source", "CADASTRO"),
    "FCT_006": ("Add the week to the calendar", "DADOS"),
    "FCT_008": ("Provider to say whether it is a return or an error", "FORNECEDOR"),
    "FCT_009": ("Provider to send the value again", "FORNECEDOR"),
    "FCT_010": ("Provider to confirm or reload the week", "FORNECEDOR"),
    "ING_005": ("Provider to send the row with valid types", "FORNECEDOR"),
}


@dataclass(frozen=True)
class PriceBand:
    local_factor: float = 3.0          # band = [median / k, median * k]
    product_factor: float = 20.0
    min_weeks: int = 26                # distinct weeks before the local median is trusted
    min_observations: int = 20         # observations before the product median is trusted


@dataclass(frozen=True)
class SeriesLimits:
    min_weeks: int = 26
    robust_z: float = 3.5
    high_ratio: float = 3.0
    low_ratio: float = 0.33
    extreme_ratio: float = 20.0
    max_spike_weeks: int = 2


@dataclass(frozen=True)
class Settings:
    synonyms: MappingProxyType = field(default_factory=lambda: MappingProxyType(CATEGORY_SYNONYMS))
    text_columns: tuple = PRODUCT_TEXT_COLUMNS
    states: tuple = STATES
    box: MappingProxyType = field(default_factory=lambda: MappingProxyType(COUNTRY_BOX))
    min_evidence: float = 0.90
    providers: MappingProxyType = field(default_factory=lambda: MappingProxyType(PROVIDERS))
    price_tolerance: float = 0.01
    price_tolerance_abs: float = 0.05
    band: PriceBand = PriceBand()
    series: SeriesLimits = SeriesLimits()
    no_territory: str = NO_TERRITORY
    cuts: MappingProxyType = field(default_factory=lambda: MappingProxyType(CUTS))
    min_coverage: float = 0.80
    max_quarantine: float = 0.05
    share_tolerance: float = 1e-4
    forbidden: tuple = FORBIDDEN_COLUMNS
