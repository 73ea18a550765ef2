"""Archives beyond the usual ones, as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: source, target, root, pattern of previews, pattern of originals, depth of folders, folders to visit at most, whether the root is known
#: to serve. Fixed values.
SOURCES = (
    ("ctx", "mars", "https://pds-imaging.jpl.nasa.gov/data/mro/mro-m-ctx-2-edr-l0-v1.0/", r"\.(jpg|jpeg)$", r"\.IMG$", 3, 80, True),
    ("moc", "mars", "https://pds-imaging.jpl.nasa.gov/data/mgs/mgs-m-moc-2-edr-narrowangle-v1.0/", r"\.(jpg|jpeg)$", r"\.IMG$", 3, 80, True),
    ("viking1", "mars", "https://pds-imaging.jpl.nasa.gov/data/viking1/v1-visual-v02/", r"\.(jpg|jpeg)$", r"\.IMG$", 3, 60, True),
    ("viking2", "mars", "https://pds-imaging.jpl.nasa.gov/data/viking2/v2-visual-v02/", r"\.(jpg|jpeg)$", r"\.IMG$", 3, 60, True),
    ("lunar_orbiter", "moon", "https://pds-imaging.jpl.nasa.gov/data/lunar_orbiter_5/", r"\.(jpg|jpeg|tif|tiff)$", r"\.IMG$", 3, 60, False),
    ("clementine", "moon", "https://pds-geosciences.wustl.edu/missions/clementine/", r"\.(jpg|jpeg)$", r"\.IMG$", 3, 60, False),
    ("m3", "moon", "https://pds-geosciences.wustl.edu/missions/chandrayaan-1/", r"\.(jpg|jpeg)$", r"\.(IMG|LBL)$", 3, 60, False),
    ("themis", "mars", "https://pds-imaging.jpl.nasa.gov/data/odyssey/themis/", r"\.(jpg|jpeg)$", r"\.IMG$", 3, 60, False),
    ("mex_hrsc", "mars", "https://psa.esa.int/", r"\.(jpg|jpeg)$", r"\.IMG$", 2, 20, False),
    ("apollo_orbital", "moon", "https://apollo.sese.asu.edu/", r"\.(jpg|jpeg)$", r"\.(tif|tiff|IMG)$", 2, 30, False),
)
SCHEMA = "source string, target string, volume string, browse_pattern string, edr_pattern string, depth int, max_dirs int, verified boolean"


def sources(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(SOURCES), SCHEMA)


def source(name: str) -> dict[str, object]:
    """One source; KeyError, naming those there are, for an unknown name."""
    for row in SOURCES:
        if row[0] == name:
            return dict(zip((f.split()[0] for f in SCHEMA.split(", ")), row, strict=True))
    raise KeyError(f"{name!r}: not one of {', '.join(sorted(r[0] for r in SOURCES))}")
