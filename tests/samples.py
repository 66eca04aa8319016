"""Small hand-made inputs, and the joined rows expected of them."""

from pyspark.sql import functions as F

from tellerloom.specs import ACCOUNTS, MASTER, TRANSACTIONS


def typed(spark, spec, records):
    """Rows given as dicts; columns left out are NULL."""
    names = spec.schema.names
    data = [tuple(record.get(name) for name in names) for record in records]
    return spark.createDataFrame(data, spec.schema)


def three_inputs(spark):
    transactions = [
        {"TransactionID": i, "CustomerID": c, "Montant": float(m), "MoyenPaiement": p}
        for i, c, m, p in [
            ("T1", "7", 10, "card"), ("T2", "7", 20, "cash"), ("T3", "8", 5, "card"),
            ("T4", "9", 99, "card"), ("T5", "08", 1, "card"),
        ]
    ]
    accounts = [
        {"customerid": c, "account_number": n, "account_type": t}
        for c, n, t in [("7", "A1", "checking"), ("7", "A2", "savings"), ("8", "A3", "checking")]
    ]
    master = [
        {"Number": 7, "Country": "FR", "Gender": "F", "State": "IDF", "NationalID": "N7"},
        {"Number": 8, "Country": "US", "Gender": None, "State": "CA", "NationalID": "N8"},
    ]
    return (
        typed(spark, TRANSACTIONS, transactions),
        typed(spark, ACCOUNTS, accounts),
        typed(spark, MASTER, master),
    )


def collected(df, *columns):
    """Rows as a set of tuples, for results without repeated rows."""
    picked = df.select(*[F.col(c) for c in columns]) if columns else df
    records = [tuple(tuple(v) if isinstance(v, list) else v for v in row) for row in picked.collect()]
    assert len(set(records)) == len(records)
    return set(records)
