"""Hand-written domain frames (FIXTURES.md §1 schemas) for edge cases."""

TARGET_SCHEMA = (
    "id string, approvedSymbol string, biotype string, "
    "subcellularLocations array<struct<location:string,source:string,termSL:string>>, "
    "tractability array<struct<id:string,value:boolean>>, "
    "safetyLiabilities array<struct<event:string>>, "
    "constraint array<struct<constraintType:string,upperRank:int>>, "
    "homologues array<struct<homologyType:string,speciesName:string,targetGeneid:string,"
    "targetPercentageIdentity:double,queryPercentageIdentity:double>>, "
    "hallmarks struct<attributes:array<struct<description:string>>>, "
    "tep struct<description:string>, "
    "chemicalProbes array<struct<isHighQuality:boolean,mechanismOfAction:string,urls:array<struct<url:string>>>>"
)
FIELDS = ["id", "approvedSymbol", "biotype", "subcellularLocations", "tractability", "safetyLiabilities",
          "constraint", "homologues", "hallmarks", "tep", "chemicalProbes"]


def target_row(id, **kw):
    row = {f: None for f in FIELDS}
    row["id"] = id
    row.update(kw)
    return tuple(row[f] for f in FIELDS)


def target_df(spark, *rows):
    return spark.createDataFrame(list(rows), TARGET_SCHEMA)


def queryset(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "targetid string")


def hom(htype, species, ident):
    return (htype, species, None, None, ident)


def loc(location, source, term):
    return (location, source, term)


def by_id(df, key="targetid"):
    out = {}
    for r in df.collect():
        out.setdefault(r[key], []).append(r.asDict())
    return out
