"""A small made-up data set for trying the pipeline: the same businesses, written differently, in three sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .sinks import write_tsv

#: (name, street, city, state, zip, country)
BUSINESSES = [
    ("Harbor Light Bakery Inc", "12 N Quay St", "Portland", "ME", "04101", "USA"),
    ("Blue Fern Bookshop LLC", "450 SW 9th Ave", "Salem", "OR", "97301", "US"),
    ("Café Amande SARL", "8 Rue des Tilleuls", "Lyon", "", "69003", "France"),
    ("Müller Uhren GmbH", "Lindenallee 77", "Köln", "", "50667", "Germany"),
    ("Sunrise Textiles Pvt Ltd", "21 Station Rd", "Surat", "Gujarat", "395003", "India"),
    ("Orchard & Vine Grocers", "3 Market Pl", "Leeds", "", "LS1 6DT", "United Kingdom"),
    ("Northern Pump Company", "900 Mill Blvd", "Calgary", "AB", "T2P 1J9", "Canada"),
    ("Silver Reef Diving", "44 Beach Rd", "Cairns", "QLD", "4870", "Australia"),
    ("Quiet Lane Dental", "5 Quiet Ln Ste 2", "Boise", "ID", "83702", "USA"),
    ("Granite Peak Roofing Co", "77 Summit Dr", "Denver", "CO", "80202", "USA"),
    ("Lotus Print House", "16 Temple St", "Singapore", "", "058560", "Singapore"),
    ("Maple Street Pharmacy", "210 E Maple St", "Ottawa", "ON", "K1P 5G4", "Canada"),
]
COLUMNS = ["id", "name", "address", "city", "state", "zip", "country"]


def rows(split: str) -> dict[str, list[tuple]]:
    """Rows of the sources 1 to 3 and known links ("truth"). Even businesses train, odd ones test, so both have half."""
    chosen = list(enumerate(BUSINESSES)) if split == "train" else [(i, b) for i, b in enumerate(BUSINESSES) if i % 2]
    out: dict[str, list[tuple]] = {"1": [], "2": [], "3": [], "truth": []}
    for i, (name, street, city, state, zip_code, country) in chosen:
        key = f"{split}_{i:02d}"
        short = " ".join(name.split()[:-1]) or name
        out["1"].append((f"a_{key}", name, street, city, state, zip_code, country))
        out["2"].append((f"b_{key}", name.upper(), street.replace("St", "Street").replace("Rd", "Road"), city, state, zip_code, country))
        out["3"].append((f"c_{key}", short, street.lower(), city.upper(), "", zip_code.replace(" ", ""), country))
        out["truth"].append((f"a_{key}", f"b_{key},c_{key}"))
        out["2"].append((f"d_{key}", f"{name.split()[0]} Holdings", f"{i + 100} Other Way", city, state, "00000", country))
    return out


def frames(spark: SparkSession, split: str) -> dict[str, DataFrame]:
    data = rows(split)
    entity = ", ".join(f"{c} string" for c in COLUMNS)
    return {k: spark.createDataFrame(v, "source1_id string, matched_id string" if k == "truth" else entity) for k, v in data.items()}


def write(spark: SparkSession, folder: str) -> None:
    """Writes train_ and test_ sources and the training truth as tab-separated files. Existing tables of these names are
    overwritten, so it must be asked for."""
    for split in ("train", "test"):
        for k, df in frames(spark, split).items():
            if k != "truth" or split == "train":
                write_tsv(df, f"{folder}/{split}_{'ground_truth' if k == 'truth' else f'source{k}'}.tsv", single_file=True)
