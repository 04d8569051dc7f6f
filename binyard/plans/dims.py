"""Flattened dimensions.

Several lookups hang off other lookups (product -> grade -> pool type,
product -> tube type -> count / designation / size / diameter, block ->
subdivision, farm -> owning company).  Joining the small tables to each
other first, and the result once to the fact stream, gives the same rows as
the chain of left joins on the fact side (left outer joins whose key comes
from the previous table associate), but every fact row goes through one
hash join per dimension instead of up to six.  Filters on dimension
attributes (presize / sample / juice flags) are applied inside the
dimension, so the fact join can be inner.

The flattened tables grow with the products/blocks/farms, not with the
facts.  Each is broadcast only behind ``Catalog.broadcast_if_small`` (a
row-count bound derived from the auto-broadcast threshold); beyond it the
fact join is a shuffle join.  The lookups inside join on unique keys, so a
flattened table has exactly its base table's rows: a row count the catalog
knows without a job (``Catalog.row_bound``) serves as the proof.  The code lists inside them go through
``Catalog.dim``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binyard.config import CURRENT
from binyard.functions.semantics import r_number_text
from binyard.operators.joins import lookup
from binyard.sources.catalog import Catalog


def place(cat: Catalog, gen: str) -> DataFrame:
    """BlockID -> BlockCode, BlockName, SubdivisionCode, SubdivisionDesc."""
    b = cat.table(gen, "sw_Farm_BlockT").select("BlockID", "BlockCode", "BlockName",
                                                "SubdivisionID")
    b = lookup(b, cat.dim(gen, "sw_SubdivisionT"), "SubdivisionID",
               ["SubdivisionCode", "SubdivisionDesc"])
    return cat.broadcast_if_small(b.drop("SubdivisionID"), cat.row_bound(gen, "sw_Farm_BlockT"))


def farm_with_owner(cat: Catalog, gen: str) -> DataFrame:
    """FarmID -> FarmCode, FarmName, owner (the farm's grower company name)."""
    f = cat.table(gen, "sw_FarmT").select("FarmID", "FarmCode", "FarmName", "GrowerCompanyID")
    f = lookup(f, cat.table(gen, "sw_CompanyT"), ("GrowerCompanyID", "CompanyID"),
               ["CompanyName"], rename={"CompanyName": "owner"})
    return cat.broadcast_if_small(f.drop("GrowerCompanyID"), cat.row_bound(gen, "sw_FarmT"))


def pallet_product(cat: Catalog) -> DataFrame:
    """ProductID -> NetFruitWeight, SampleFlag, GradeDesc, PoolByRule."""
    p = cat.table(CURRENT, "sw_ProductT").select("ProductID", "NetFruitWeight", "SampleFlag",
                                                 "GradeID")
    p = lookup(p, cat.dim(CURRENT, "sw_GradeT"), "GradeID", ["GradeDesc", "PoolTypeID"])
    p = lookup(p, cat.dim(CURRENT, "sys_fi_Pool_TypeT"), "PoolTypeID", ["PoolByRule"])
    return cat.broadcast_if_small(p.drop("GradeID", "PoolTypeID"), cat.row_bound(CURRENT, "sw_ProductT"))


def tube_product(cat: Catalog) -> DataFrame:
    """Tube products only (neither presize nor sample): ProductID -> pack code,
    TubesPerCarton, RTEConversion.  The code is the NULL-propagating
    concatenation of designation, count, tubes per carton, fruit per tube,
    tube diameter and size (numbers printed without a trailing .0)."""
    d = lambda n: cat.dim(CURRENT, n)
    p = (cat.table(CURRENT, "sw_ProductT")
         .select("ProductID", "TubesPerCarton", "TubeTypeID", "PresizeFlag", "SampleFlag",
                 "CountID", "DesignationID", "SizeID")
         .filter(~F.col("PresizeFlag") & ~F.col("SampleFlag")))
    p = lookup(p, d("sw_Tube_TypeT"), "TubeTypeID", ["RTEConversion", "TubeDiameterID",
                                                     "FruitPerTube"])
    p = lookup(p, d("sw_CountT"), "CountID", ["CountCode"])
    p = lookup(p, d("sw_DesignationT"), "DesignationID", ["DesignationCode"])
    p = lookup(p, d("sw_SizeT"), "SizeID", ["SizeCode"])
    p = lookup(p, d("sw_Tube_DiameterT"), "TubeDiameterID", ["TubeDiameter"])
    code = F.concat(F.col("DesignationCode"), F.col("CountCode"), r_number_text("TubesPerCarton"),
                    r_number_text("FruitPerTube"), r_number_text("TubeDiameter"),
                    F.col("SizeCode"))
    return cat.broadcast_if_small(
        p.select("ProductID", code.alias("code"), "TubesPerCarton", "RTEConversion"),
        cat.row_bound(CURRENT, "sw_ProductT"))


def presize_product(cat: Catalog) -> DataFrame:
    """Non-juice presize products: ProductID -> PresizeAvgTubeWeight, RTEConversion."""
    p = cat.table(CURRENT, "sw_ProductT").select("ProductID", "TubeTypeID", "GradeID")
    p = lookup(p, cat.dim(CURRENT, "sw_Tube_TypeT"), "TubeTypeID",
               ["PresizeAvgTubeWeight", "RTEConversion"])
    p = lookup(p, cat.dim(CURRENT, "sw_GradeT"), "GradeID", ["JuiceFlag"])
    return cat.broadcast_if_small(
        p.filter(~F.col("JuiceFlag")).select("ProductID", "PresizeAvgTubeWeight", "RTEConversion"),
        cat.row_bound(CURRENT, "sw_ProductT"))


def carton_product(cat: Catalog) -> DataFrame:
    """ProductID -> TubesPerCarton, RTEConversion (repacked cartons)."""
    p = cat.table(CURRENT, "sw_ProductT").select("ProductID", "TubesPerCarton", "TubeTypeID")
    p = lookup(p, cat.dim(CURRENT, "sw_Tube_TypeT"), "TubeTypeID", ["RTEConversion"])
    return cat.broadcast_if_small(p.drop("TubeTypeID"), cat.row_bound(CURRENT, "sw_ProductT"))
