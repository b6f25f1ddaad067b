"""Reference data that comes with the library."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Merchant category codes.
MCC_CODES = [
    ("5411", "Grocery stores and supermarkets", "Groceries"),
    ("5812", "Restaurants", "Dining"),
    ("5814", "Fast food", "Dining"),
    ("5541", "Service stations", "Transport"),
    ("4111", "Commuter transport", "Transport"),
    ("4121", "Taxis and rideshare", "Transport"),
    ("5311", "Department stores", "Shopping"),
    ("5651", "Clothing stores", "Shopping"),
    ("5732", "Electronics stores", "Shopping"),
    ("5912", "Pharmacies", "Health"),
    ("4814", "Telecommunication services", "Bills"),
    ("4900", "Utilities", "Bills"),
    ("5942", "Book stores", "Leisure"),
    ("7832", "Cinemas", "Leisure"),
    ("4511", "Airlines", "Travel"),
    ("7011", "Hotels and lodging", "Travel"),
    ("5200", "Home supply stores", "Home"),
    ("5999", "Miscellaneous retail", "Shopping"),
]
# Transaction types.
TRANSACTION_TYPES = [
    ("CARD_PAYMENT", "SPEND", True),
    ("REVERSAL", "SPEND", True),
    ("SEPA_TRANSFER_OUT", "TRANSFER", False),
    ("SEPA_TRANSFER_IN", "TRANSFER", False),
    ("INTERNAL_TRANSFER", "TRANSFER", False),
    ("SALARY", "INCOME", False),
    ("ATM_WITHDRAWAL", "CASH", False),
    ("CASH_DEPOSIT", "CASH", False),
    ("FEE", "FEE", False),
    ("INTEREST", "INTEREST", False),
]
# End of the fixed values.


def mcc_codes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(MCC_CODES, "mcc string, mcc_description string, spend_category string")


def transaction_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TRANSACTION_TYPES, "txn_type string, txn_category string, is_customer_spend boolean")
