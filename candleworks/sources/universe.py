"""The ticker universe as a dimension table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The core universe and the candidates for its expansion.
CORE = (
    "SAP.DE ASML.AS MC.PA AIR.PA SAN.MC ENEL.MI SHEL.L BP.L NESN.SW NOVN.SW RWE.DE OR.PA "
    "BNP.PA DBK.DE ADYEN.AS"
).split()
EXPANSION = (
    "BAYN.DE SIE.DE DTE.DE VOW3.DE BMW.DE SU.PA ENI.MI ISP.MI IBE.MC ITX.MC PHIA.AS ABI.BR "
    "KER.PA SUHV.VI VOLV-B.ST ERIC-B.ST TELIA.ST NOKIA.HE FORTUM.HE ORSTED.CO MAERSK-B.CO "
    "CARL-B.CO EQNR.OL NHY.OL DNB.OL TOM.OL TTE.PA PUB.PA STM.MI UCG.MI SGRE.MC UHR.SW "
    "CSGN.SW UBSG.SW LONN.SW RO.PA ACA.PA EN.PA ENGI.PA HO.PA DG.PA VIV.PA AENA.MC FER.MC "
    "GRF.MC REL.L ULVR.L LSEG.L AZN.L GSK.L HSBA.L BARC.L NG.L RR.L SPX.L"
).split()


def universe(spark: SparkSession) -> DataFrame:
    """(ordinal, symbol, universe): core first, then expansion, repeats kept."""
    rows = [(i, s, "core" if i < len(CORE) else "expansion") for i, s in enumerate([*CORE, *EXPANSION])]
    return spark.createDataFrame(rows, "ordinal int, symbol string, universe string")


def union_universe(core: DataFrame, expansion: DataFrame) -> DataFrame:
    """The same from any two symbol tables."""
    label = lambda df, name: df.select("symbol", F.lit(name).alias("universe"))
    return label(core, "core").unionByName(label(expansion, "expansion"))
