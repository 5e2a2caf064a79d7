"""Code sets: every accepted spelling, lower case, and the value it stands for."""

from __future__ import annotations

# The accepted spellings of each coded column.
STATUS = {
    "success": "Success",
    "succes": "Success",
    "sucess": "Success",
    "failed": "Failed",
    "faild": "Failed",
    "pending": "Pending",
}
PAYMENT = {
    "upi": "UPI",
    "cash": "Cash",
    "card": "Card",
    "netbanking": "NetBanking",
    "cheque": "Cheque",
}
REFUND = {"true": True, "y": True, "1": True, "false": False, "n": False, "0": False}
GENDER = {
    "male": "Male",
    "m": "Male",
    "female": "Female",
    "f": "Female",
    "other": "Other",
    "unknown": "Unknown",
}
KYC = {"verified": "Verified", "pending": "Pending", "rejected": "Rejected"}
REGION = {"north": "North", "south": "South", "east": "East", "west": "West"}
BRANCH_TYPE = {"urban": "Urban", "rural": "Rural"}
CATEGORY = {"retail": "Retail", "sme": "SME", "corporate": "Corporate"}
PRODUCT_TYPE = {
    "savings account": "Savings Account",
    "loan": "Loan",
    "credit card": "Credit Card",
    "fixed deposit": "Fixed Deposit",
}
BOOL_TEXT = {"true": True, "false": False}
