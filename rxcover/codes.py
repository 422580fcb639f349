"""Fixed values of the medicines dictionary and of its reports.

FIXED VALUES: everything in this module must stay exactly as written. The
unit codes are concept identifiers of the source data, the labels are the
WHO ATC group names shown in the reports, and the fallback rules are the
published defined daily doses used to patch missing values. They are data,
not logic; the operators that use them live in ``rxcover.functions`` and
``rxcover.operators``.
"""

from __future__ import annotations

# FIXED VALUES: unit-of-measure concept code -> unit text. A code that is
# not listed falls through unchanged.
UNIT_CODES: dict[str, str] = {
    "258684004": "mg",
    "258682000": "g",
    "258685003": "microgram",
    "258676002": "microgram",
    "258717005": "ng",
    "258774008": "mL",
    "258773002": "L",
    "396186001": "MU",
    "258664008": "U",
    "258718000": "mmol",
}

# FIXED VALUES: unit used when a classification record carries none.
DEFAULT_UNIT = "mg"

# FIXED VALUES: dose fallbacks, in the order they are tried:
# (lower-case name fragment, dose, unit, ATC code). The first fragment found
# in a product name whose dose is missing wins.
FALLBACK_RULES: tuple[tuple[str, float, str, str], ...] = (
    ("co-amoxiclav", 3.0, "g", "J01CR02"),
    ("co-fluampicil", 2.0, "g", "J01CA51"),
    ("piperacillin / tazobactam", 14.0, "g", "J01CR05"),
)

# FIXED VALUES: conversion of a dose to milligrams, keyed by the trimmed,
# lower-cased unit: (operator, factor). Any other unit gives no mg value.
MG_CONVERSIONS: dict[str, tuple[str, float]] = {
    "mg": ("*", 1.0),
    "g": ("*", 1000.0),
    "kg": ("*", 1_000_000.0),
    "microgram": ("/", 1000.0),
    "mcg": ("/", 1000.0),
    "µg": ("/", 1000.0),
    "ng": ("/", 1_000_000.0),
}

# FIXED VALUES: ATC level 1 anatomical group labels.
ATC_GROUP_LABELS: dict[str, str] = {
    "A": "Alimentary & Metabolism",
    "B": "Blood & Blood Forming Organs",
    "C": "Cardiovascular",
    "D": "Dermatologicals",
    "G": "Genito-Urinary & Sex Hormones",
    "H": "Hormones (Non-Sex)",
    "J": "Anti-Infectives (Systemic)",
    "L": "Antineoplastic & Immunomodulating",
    "M": "Musculoskeletal",
    "N": "Nervous System",
    "P": "Antiparasitic",
    "R": "Respiratory",
    "S": "Sensory Organs",
    "V": "Various",
}

# FIXED VALUES: ATC J01 level 3 pharmacological subclass labels.
J01_SUBCLASS_LABELS: dict[str, str] = {
    "J01A": "Tetracyclines",
    "J01B": "Amphenicols",
    "J01C": "Beta-lactam Penicillins",
    "J01D": "Other Beta-lactams (Cephalosporins etc.)",
    "J01E": "Sulfonamides & Trimethoprim",
    "J01F": "Macrolides, Lincosamides & Streptogramins",
    "J01G": "Aminoglycoside Antibacterials",
    "J01M": "Quinolone Antibacterials",
    "J01R": "Combinations",
    "J01X": "Other Antibacterials",
}

# FIXED VALUES: ATC prefix lengths of levels 1 to 4 (level 5 is the code).
ATC_LEVEL_LENGTHS: dict[int, int] = {1: 1, 2: 3, 3: 4, 4: 5}

# FIXED VALUES: code prefixes that mark an antibacterial product.
ANTIBIOTIC_ATC_PREFIX = "J01"
ANTIBIOTIC_BNF_PREFIX = "0501"

# FIXED VALUES: mapping status texts, in display (factor level) order.
STATUS_BOTH = "ATC + BNF"
STATUS_ATC_ONLY = "ATC only"
STATUS_BNF_ONLY = "BNF only"
STATUS_UNMAPPED = "Unmapped"
STATUS_LEVELS_4 = (STATUS_BOTH, STATUS_ATC_ONLY, STATUS_BNF_ONLY, STATUS_UNMAPPED)
STATUS_LEVELS_3 = (STATUS_BOTH, STATUS_BNF_ONLY, STATUS_UNMAPPED)

# FIXED VALUES: wide count columns of the antibiotic summary and their status.
ABX_STATUS_COLUMNS: dict[str, str] = {
    "fully_mapped": STATUS_BOTH,
    "bnf_only": STATUS_BNF_ONLY,
    "unmapped": STATUS_UNMAPPED,
}

# FIXED VALUES: two-way ATC gap status of antibiotics.
GAP_MAPPED = "Mapped to ATC"
GAP_MISSING = "Missing ATC"

# FIXED VALUES: display headers of the unmapped-antibiotic table.
ABX_MISSING_HEADERS: dict[str, str] = {
    "vpid": "Virtual Product ID (VPID)",
    "vmp_nm": "Virtual Medicinal Product (VMP) Name",
    "bnf_code": "British National Formulary (BNF) Code",
    "mapping_status": "Current NHS Mapping Status",
}

# FIXED VALUES: display headers of the dose lookup table.
DDD_LOOKUP_HEADERS: dict[str, str] = {
    "atc_code": "ATC Code",
    "ddd": "DDD",
    "ddd_uom": "UOM",
    "ddd_mg": "DDD (mg)",
    "drug_names": "Drug Names (Searchable)",
}

# FIXED VALUES: separator between drug names in the dose lookup.
NAME_SEPARATOR = " | "

# FIXED VALUES: page sizes of the two tables.
ABX_MISSING_PAGE_SIZE = 10
DDD_LOOKUP_PAGE_SIZE = 15

# FIXED VALUES: load status messages.
LOADED_MESSAGE = "Loaded {n} records."
MISSING_MESSAGE = "Data file not found. Run pipeline first."

# FIXED VALUES: text before the total of the overall chart.
TOTAL_TEXT = "Total VMPs: "

# FIXED VALUES: the "no filter" choice of the group parameter.
ALL_GROUPS = "All"

# FIXED VALUES: groups smaller than this are left out of the gap rate report.
MIN_GROUP_SIZE = 20
