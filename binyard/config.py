"""Report configuration.

Everything a report needs that is *data* rather than logic lives here: the
season code maps of the two ERP generations, label maps, product constants,
prefixes and template names.  A ``ReportConfig`` bundles them so a caller can
extend, e.g., the season map for seasons after 2023 without touching code.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values.  These must equal the reference's for the reports to agree;
# they are listed plainly, in the reference's own order (first match wins).
# ---------------------------------------------------------------------------

# SeasonID code -> season (harvest year), per ERP generation.
LEGACY_SEASON_CODES = {2: 2016, 3: 2017, 4: 2018, 5: 2019}
CURRENT_SEASON_CODES = {6: 2020, 7: 2021, 8: 2022, 9: 2023}

# StorageTypeID -> storage type label; anything else is "RA".
STORAGE_TYPE_BY_ID = ((4, "CA"), (7, "RA"))
STORAGE_TYPE_DEFAULT = "RA"

# Legacy storage type description -> storage type label; anything else "RA".
STORAGE_TYPE_BY_TEXT = (("Normal Air", "RA"), ("CA & Smartfreshed", "CA"))

# Current storage site: one company splits on SeasonID, everything else is the
# default site.
CURRENT_SITE_COMPANY = "Te Ipu Packhouse (RO)"
CURRENT_SITE_SPLIT_SEASON_ID = 6          # SeasonID > 6 -> new site
CURRENT_SITE_NEW = "Te Ipu"
CURRENT_SITE_OLD = "Cooper Street"
CURRENT_SITE_BY_NAME = (("Berl Property Ltd", "Raupare Rd"),)
CURRENT_SITE_DEFAULT = "Raupare Rd"

# Legacy storage site by company name; default is the company name itself.
LEGACY_SITE_BY_NAME = (
    ("Rockit Packing Company Ltd", "Cooper Street"),
    ("Berl Property Ltd", "Raupare Rd"),
    ("Bostock New Zealand", "Henderson Road"),
    ("T & G (Apollo)", "T&G Whakatu"),
    ("Everest Kool SolutioNZ", "Everest Kool Omahu Rd"),
    ("Crasborn Fresh Harvest ", "FreshMax Omahu Road"),
    ("2019 Crasborn Fresh Harvest", "Raupare Rd"),
)

# Defect labels merged after aggregation.
RUSSET_SOURCE_LABELS = ("Russet Cheek", "Russet Stem")
RUSSET_LABEL = "Russet"

# QA templates selected per generation.
CURRENT_TEMPLATES = ("Grade Analysis",)
LEGACY_TEMPLATES = ("Reject Analysis",)

# Product constants.
JUICE_PRODUCT_ID = 278
PRESIZE_SKIP_NULL_WEIGHT_PRODUCT_ID = 90

# Pack-code prefixes (matched ignoring case) and the batch from which the
# temporary-Z prefix is split out of tube packs.
EXPORT_BIN_PREFIX = "ROC999"
JAPAN_TRAY_PREFIX = "JAP"
TEMPZ_PREFIX = "RKT"
TEMPZ_FIRST_BATCH_ID = 2430

# Loose-fruit rule: weighed pools, excluding one grade.
POOL_BY_WEIGHT = "KG"
EXCLUDED_LOOSE_GRADE = "Push Pack"

# Shift code of every legacy batch.
LEGACY_SHIFT_CODE = "Day"

LEGACY = "legacy"
CURRENT = "current"
GENERATIONS = (LEGACY, CURRENT)


@dataclass(frozen=True)
class ReportConfig:
    """All tunable report data in one immutable object."""

    season_codes: dict = field(default_factory=lambda: {
        LEGACY: dict(LEGACY_SEASON_CODES),
        CURRENT: dict(CURRENT_SEASON_CODES),
    })
    #: Calendar years whose [1 Jan, 1 Jan next year) bands give a season to
    #: current fact rows that only carry a creation timestamp.  Derived from
    #: ``season_codes``; given values must cover every current season.
    timestamp_seasons: tuple | None = None
    templates: dict = field(default_factory=lambda: {
        LEGACY: LEGACY_TEMPLATES,
        CURRENT: CURRENT_TEMPLATES,
    })
    #: Collation of texts that the server compares with literals (site names,
    #: QA templates); None: trailing blanks are ignored and case counts.
    server_collation: str | None = None
    juice_product_id: int = JUICE_PRODUCT_ID
    presize_skip_null_weight_product_id: int = PRESIZE_SKIP_NULL_WEIGHT_PRODUCT_ID
    tempz_first_batch_id: int = TEMPZ_FIRST_BATCH_ID

    def __post_init__(self):
        current = tuple(sorted(set(self.season_codes[CURRENT].values())))
        if self.timestamp_seasons is None:
            object.__setattr__(self, "timestamp_seasons", current)
        elif missing := set(current) - set(self.timestamp_seasons):
            raise ValueError(f"no timestamp band for current seasons {sorted(missing)}")

    def seasons_of(self, generation: str) -> set[int]:
        return set(self.season_codes[generation].values())

    def generations_for(self, seasons) -> list[str]:
        """Generations whose season set meets the request (legacy first)."""
        wanted = set(int(s) for s in seasons)
        return [g for g in GENERATIONS if wanted & self.seasons_of(g)]


DEFAULT_CONFIG = ReportConfig()
