"""The built-in rule catalogue: 63 rules over ingest, facts, coverage, publication and four dimensions."""
from __future__ import annotations

from .model import ALERTED, APPROVED, CORRECTED, QUARANTINED, REJECTED, Catalogue, Rule

_TREATMENT = {
    APPROVED: "informative flag, the row goes on",
    CORRECTED: "corrected, original kept in <column>_raw and in the trail",
    ALERTED: "flagged, data unchanged",
    QUARANTINED: "removed with reason and payload until the source is fixed",
    REJECTED: "discarded or blocked with justification",
}

# Id, dimension, severity and outcome of every rule. The texts are ours.
_RULES = [
    # id, dimension, severity, outcome, scope, description, fails when
    ("ING_001", "RECONCILIACAO", "ALTA", ALERTED, "source file", "Loaded rows equal declared rows", "loaded <> declared"),
    ("ING_002", "VALIDADE", "CRITICA", REJECTED, "provider schema", "Required columns are present", "a required column is missing"),
    ("ING_003", "VALIDADE", "BAIXA", ALERTED, "provider schema", "No unmapped column (schema drift)", "a column is not mapped"),
    ("ING_004", "CONSISTENCIA", "MEDIA", ALERTED, "legacy measures", "Legacy columns equal the standard ones", "legacy <> standard"),
    ("ING_005", "VALIDADE", "CRITICA", QUARANTINED, "fact", "Week, numbers and ingestion time have valid types", "text does not convert"),
    ("FCT_001", "UNICIDADE", "BAIXA", REJECTED, "fact, all columns", "Exact duplicate", "second or later copy of a row hash"),
    ("FCT_002", "UNICIDADE", "CRITICA", QUARANTINED, "week x store x code", "Conflicting versions in one provider", "several versions of a key"),
    ("FCT_003", "CONSISTENCIA", "ALTA", QUARANTINED, "week x store x code", "Key reported by two providers", "several providers of a key"),
    ("FCT_004", "INTEGRIDADE_REFERENCIAL", "CRITICA", QUARANTINED, "fact.store_id", "Store exists", "store not in the dimension"),
    ("FCT_005", "INTEGRIDADE_REFERENCIAL", "CRITICA", QUARANTINED, "fact.ean", "Product exists", "code not in the dimension"),
    ("FCT_006", "INTEGRIDADE_REFERENCIAL", "CRITICA", QUARANTINED, "fact.year_week", "Week exists", "week not in the calendar"),
    ("FCT_007", "ACURACIA", "ALTA", CORRECTED, "fact value", "Negative value with a proven sign flip", "value < 0 and units x price = -value within tolerance"),
    ("FCT_008", "VALIDADE", "ALTA", QUARANTINED, "fact value", "Negative value without proof", "value < 0"),
    ("FCT_009", "ACURACIA", "CRITICA", QUARANTINED, "value / units", "Unit price inside the band", "unit price outside the band"),
    ("FCT_010", "ACURACIA", "CRITICA", QUARANTINED, "series", "Short extreme spike", "class POSSIVEL_ERRO"),
    ("FCT_011", "ACURACIA", "MEDIA", ALERTED, "series", "Sustained unusual event", "class EVENTO_ATIPICO"),
    ("FCT_012", "ACURACIA", "MEDIA", ALERTED, "series", "Unusual drop", "class QUEDA_ATIPICA"),
    ("FCT_013", "CONSISTENCIA", "MEDIA", ALERTED, "fact value", "Value agrees with units x price", "difference above tolerance"),
    ("FCT_014", "COMPLETUDE", "MEDIA", ALERTED, "fact.units", "Zero units with positive value", "units = 0 and value > 0"),
    ("FCT_015", "COMPLETUDE", "MEDIA", ALERTED, "fact volume", "Zero volume with positive units", "volume = 0 and units > 0"),
    ("FCT_016", "COBERTURA", "INFO", APPROVED, "fact", "Explicit zero sale", "units = volume = value = 0"),
    ("FCT_017", "TEMPORALIDADE", "ALTA", ALERTED, "week x ingestion", "Week closed at ingestion", "ingested before the week ended"),
    ("FCT_018", "COMPLETUDE", "BAIXA", ALERTED, "fact.territory_id", "Territory found", "no territory after the fallbacks"),
    ("FCT_019", "CONSISTENCIA", "MEDIA", ALERTED, "competitor flag", "Competitor flag agrees with the product", "flag disagrees"),
    ("FCT_020", "ACURACIA", "MEDIA", ALERTED, "fact volume (dataset)", "Volume reconciles with units x package", "difference above 1 %"),
    ("COV_001", "UNICIDADE", "CRITICA", QUARANTINED, "provider x week x chain", "Coverage key is unique", "several rows of a key"),
    ("COV_002", "CONSISTENCIA", "MEDIA", ALERTED, "received stores", "Received does not exceed expected", "received > expected"),
    ("COV_003", "CONSISTENCIA", "MEDIA", ALERTED, "file flag x stores", "File received with zero stores", "flag Y and 0 stores"),
    ("COV_004", "CONSISTENCIA", "MEDIA", ALERTED, "file flag x fact", "File declared missing but rows exist", "flag N and rows > 0"),
    ("COV_005", "TEMPORALIDADE", "BAIXA", ALERTED, "delivery dates", "Delivered on time", "actual > expected date"),
    ("COV_006", "TEMPORALIDADE", "MEDIA", ALERTED, "due date x week end", "Due after the week ends", "due date <= week end"),
    ("COV_007", "INTEGRIDADE_REFERENCIAL", "ALTA", QUARANTINED, "chain / week", "Chain and week exist", "chain or week unknown"),
    ("COV_008", "RECONCILIACAO", "BAIXA", ALERTED, "received stores x fact", "Declared stores cover observed ones", "observed > declared"),
    ("GLD_001", "RECONCILIACAO", "CRITICA", REJECTED, "fact", "Rows are conserved", "in <> kept + removed"),
    ("GLD_002", "RECONCILIACAO", "CRITICA", REJECTED, "kept x published", "Joins do not multiply value", "totals or row counts differ"),
    ("GLD_003", "CONSISTENCIA", "CRITICA", REJECTED, "share cells", "Shares of a cell sum to one", "sum differs by more than the tolerance"),
    ("GLD_004", "COBERTURA", "ALTA", ALERTED, "share cells", "Cell is good enough to be official", "cell is not official"),
    ("GLD_005", "VALIDADE", "CRITICA", REJECTED, "published tables", "No personal or sensitive column", "a forbidden column is present"),
    ("PRD_001", "UNICIDADE", "CRITICA", QUARANTINED, "product_id", "Product id is unique", "several rows of an id"),
    ("PRD_002", "UNICIDADE", "CRITICA", REJECTED, "product code", "Product code is unique", "not the survivor of its code"),
    ("PRD_003", "VALIDADE", "MEDIA", ALERTED, "product code", "Code has 13 digits", "pattern does not match"),
    ("PRD_004", "VALIDADE", "BAIXA", CORRECTED, "product texts", "Text is normalised", "text differs from its normal form"),
    ("PRD_005", "VALIDADE", "ALTA", CORRECTED, "category", "Category spelling is official", "category is a known synonym"),
    ("PRD_006", "COMPLETUDE", "ALTA", CORRECTED, "category", "Category is filled", "blank with a reference value"),
    ("PRD_007", "CONSISTENCIA", "ALTA", CORRECTED, "category x subcategory", "Conflict with evidence", "conflict and the description names the subcategory"),
    ("PRD_008", "CONSISTENCIA", "ALTA", ALERTED, "category x subcategory", "Conflict without evidence", "conflict remains"),
    ("LOJ_001", "UNICIDADE", "CRITICA", QUARANTINED, "store_id", "Store id is unique", "several rows of an id"),
    ("LOJ_002", "CONSISTENCIA", "ALTA", CORRECTED, "state x city", "State agrees with the city", "state differs from the city's dominant state"),
    ("LOJ_003", "VALIDADE", "BAIXA", CORRECTED, "tax id", "Tax id has 14 digits without mask", "masked but 14 digits remain"),
    ("LOJ_004", "VALIDADE", "BAIXA", ALERTED, "coordinates", "Coordinate inside the country box", "outside the box"),
    ("LOJ_005", "ACURACIA", "INFO", ALERTED, "coordinates (dataset)", "Coordinates follow the city", "city centres vary less than one city does"),
    ("LOJ_006", "COMPLETUDE", "MEDIA", ALERTED, "store territory", "Territory is filled", "blank"),
    ("LOJ_007", "COMPLETUDE", "BAIXA", ALERTED, "store seller", "Seller is filled", "blank"),
    ("TER_001", "CONSISTENCIA", "ALTA", CORRECTED, "validity interval", "Intervals do not overlap", "end reaches the next start"),
    ("TER_002", "COMPLETUDE", "MEDIA", ALERTED, "history territory", "Territory is filled", "blank"),
    ("TER_003", "COBERTURA", "BAIXA", ALERTED, "stores x history (dataset)", "Every store has a history", "store without any interval"),
    ("TER_004", "INTEGRIDADE_REFERENCIAL", "ALTA", QUARANTINED, "history store", "Store exists", "store not in the dimension"),
    ("TER_005", "COMPLETUDE", "BAIXA", ALERTED, "history seller", "Seller is filled", "blank"),
    ("TER_006", "UNICIDADE", "ALTA", QUARANTINED, "store x category x start", "One interval per start day", "several intervals start that day"),
    ("CAL_001", "CONSISTENCIA", "MEDIA", CORRECTED, "calendar year", "Year is the ISO year", "year differs from Thursday's year"),
    ("CAL_002", "VALIDADE", "CRITICA", REJECTED, "calendar weeks", "Weeks are whole and contiguous", "not Monday to Sunday, or a gap"),
    ("CAL_003", "UNICIDADE", "CRITICA", REJECTED, "calendar label", "Label is unique and ISO", "duplicate or not the ISO label"),
    ("CAL_004", "CONSISTENCIA", "MEDIA", CORRECTED, "calendar month", "Month is Thursday's month", "month differs"),
]


def default_catalogue() -> Catalogue:
    return Catalogue(
        Rule(i, dim, sev, out, scope, text, fails, _TREATMENT[out]) for i, dim, sev, out, scope, text, fails in _RULES
    )
