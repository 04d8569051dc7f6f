"""The fixed values of the reports, written out: the oracle SQL takes them from
``binyard.config`` too, so a wrong value there would pass both sides."""

from binyard import config as C

# Fixed values, as the reports define them.


def test_season_codes():
    assert C.LEGACY_SEASON_CODES == {2: 2016, 3: 2017, 4: 2018, 5: 2019}
    assert C.CURRENT_SEASON_CODES == {6: 2020, 7: 2021, 8: 2022, 9: 2023}
    assert C.DEFAULT_CONFIG.timestamp_seasons == (2020, 2021, 2022, 2023)


def test_products_and_prefixes():
    assert C.JUICE_PRODUCT_ID == 278
    assert C.PRESIZE_SKIP_NULL_WEIGHT_PRODUCT_ID == 90
    assert (C.EXPORT_BIN_PREFIX, C.JAPAN_TRAY_PREFIX, C.TEMPZ_PREFIX) == ("ROC999", "JAP", "RKT")
    assert C.TEMPZ_FIRST_BATCH_ID == 2430


def test_loose_rule():
    assert C.POOL_BY_WEIGHT == "KG"
    assert C.EXCLUDED_LOOSE_GRADE == "Push Pack"


def test_storage_types():
    assert C.STORAGE_TYPE_BY_ID == ((4, "CA"), (7, "RA"))
    assert C.STORAGE_TYPE_BY_TEXT == (("Normal Air", "RA"), ("CA & Smartfreshed", "CA"))
    assert C.STORAGE_TYPE_DEFAULT == "RA"
