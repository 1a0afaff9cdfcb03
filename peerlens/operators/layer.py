"""The data behind the cluster map: one row per marker."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerlens.functions.text import shown, thousands

# The qualitative palette, one colour per cluster, in order.
PALETTE = ["#E41A1C", "#377EB8", "#4DAF4A", "#984EA3", "#FF7F00", "#FFFF33", "#A65628"]
# The marker style.
MARKER = {"weight": 1, "radius": 5, "color": "black", "fill_opacity": 0.8}
# Fixed value: the notice shown on the map.
ATTRIBUTION = (
    "Source: Office for National Statistics licensed under the Open Government Licence v.3.0"
    "<br>Contains OS data © Crown copyright and database right [2023]"
)

# The columns shown, in order.
SHOWN = [
    "ORG_CODE", "ORG_NAME", "POSTCODE", "POPN", "ICB_CODE", "ICB_NAME",
    "NHSER_CODE", "NHSER_NAME", "LATITUDE", "LONGITUDE",
]


def map_layer(index: DataFrame, clusters: DataFrame, palette: Sequence[str] = PALETTE) -> DataFrame:
    """Markers of all cluster layers: chosen columns, popup text, colour and layer name.

    Clusters beyond the palette start it over, so every cluster has a colour.

    The layers differ only in their cluster, so they are one table; written
    partitioned by ``cluster``, reading one layer reads one folder.
    """
    joined = index.select(*SHOWN).join(clusters.select("ORG_CODE", "cluster"), "ORG_CODE")
    # The popup's labels.
    name_code = [("Practice: ", "ORG_NAME", "ORG_CODE"), ("ICB: ", "ICB_NAME", "ICB_CODE"), ("Region: ", "NHSER_NAME", "NHSER_CODE")]
    lines = [
        F.concat(F.lit(label), shown(F.col(name)), F.lit(" - ["), shown(F.col(code)), F.lit("]<br>"))
        for label, name, code in name_code
    ]
    popup = F.concat(*lines, F.lit("Popn: "), shown(thousands(F.col("POPN"))))
    colours = F.array(*[F.lit(c) for c in palette])
    return joined.select(
        *SHOWN,
        "cluster",
        F.col("cluster").cast("string").alias("layer"),
        F.get(colours, F.pmod(F.col("cluster") - 1, F.lit(len(palette)))).alias("fill_color"),
        popup.alias("popup"),
        *[F.lit(v).alias(k) for k, v in MARKER.items()],
        F.lit(ATTRIBUTION).alias("attribution"),
    )
