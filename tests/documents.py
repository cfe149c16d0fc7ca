"""Hand-written documents, one per edge case."""


def transaction(id_="7", amount="12.30", customer="3", time="2024-01-31T04:08:41", place="Paris", result="Success"):
    fields = {
        "TransactionId": id_,
        "Amount": amount,
        "CustomerId": customer,
        "DateTime": time,
        "Location": place,
        "Result": result,
    }
    body = "".join(f"<{name}>{text}</{name}>" for name, text in fields.items() if text is not None)
    return f"<Transaction>{body}</Transaction>"


def data(*transactions, root="Data"):
    return f"<{root}>{''.join(transactions)}</{root}>"


# Three transactions of which the first and the last share an id, indented as writers do.
SAMPLE = "<?xml version='1.0'?>\n" + data(
    "\n  " + transaction("501", "19.05", "8", "2022-02-28T23:59:59", "Lyon", "Failure"),
    "\n  " + transaction("77", "640.00", "12", "2022-03-01T00:00:00", "Oslo"),
    "\n  " + transaction("501", "20.10", "9", "2022-02-28T23:59:59", "Bern"),
    "\n",
)

# name: (text, document class, reason, valid rows, rejects)
CASES = {
    "ok2": ('<?xml version="1.0"?>' + data(transaction("1"), transaction("2")), "valid", None, 2, 0),
    "ok1": (data(transaction()), "valid", None, 1, 0),
    "empty": (data(), "empty", None, 0, 0),
    "empty_closed": ("<Data/>", "empty", None, 0, 0),
    "trunc": (f"<Data>{transaction()}<Transaction><Trans", "malformed", "bad_xml", 0, 0),
    "junk": ("not xml", "malformed", "bad_xml", 0, 0),
    "emptystr": ("", "malformed", "bad_xml", 0, 0),
    "badid": (data(transaction("abc"), transaction("2")), "valid", None, 1, 1),
    "badts": (data(transaction(time="yesterday noon")), "valid", None, 0, 1),
    "timeonly": (data(transaction(time="04:08:41")), "valid", None, 0, 1),
    "badcust": (data(transaction(customer="1.5")), "valid", None, 0, 1),
    "badamt": (data(transaction(amount="12,5")), "valid", None, 1, 0),
    "bigamt": (data(transaction(amount="123456789.999")), "valid", None, 1, 0),
    "extra": (data(transaction(), "<Foo>1</Foo>"), "valid", None, 1, 0),
    "otherroot": (data(transaction(), root="Zed"), "valid", None, 1, 0),
    "missing": (data(transaction(customer=None)), "valid", None, 1, 0),
    "blankcust": (data(transaction(customer="")), "valid", None, 1, 0),
    "nokey": (data(transaction(None)), "valid", None, 0, 1),
    "blankkey": (data(transaction("  ")), "valid", None, 0, 1),
    "notime": (data(transaction(time=None)), "valid", None, 1, 0),
    "nothing": (data("<Transaction/>"), "valid", None, 0, 1),
    "bom": ("﻿" + data(transaction()), "valid", None, 1, 0),
    "two_roots": (data(transaction("1")) + data(transaction("2")), "malformed", "unread_transactions", 1, 0),
    "namespace": (
        '<d:Data xmlns:d="u"><d:Transaction><d:TransactionId>1</d:TransactionId></d:Transaction></d:Data>',
        "malformed",
        "unread_transactions",
        0,
        0,
    ),
    "spaced_end": (
        data(transaction("1").replace("</Transaction>", "</Transaction\n >"), transaction("2")) + data(transaction("3")),
        "malformed",
        "unread_transactions",
        2,
        0,
    ),
    "spaced_end_ok": (data(transaction("1").replace("</Transaction>", "</Transaction  >")), "valid", None, 1, 0),
    "like_named": (data(transaction("1"), "<TransactionType>x</TransactionType>"), "valid", None, 1, 0),
    "prefixed_beside": (
        data(transaction("1"), '<d:Transaction xmlns:d="u"><d:TransactionId>2</d:TransactionId></d:Transaction>'),
        "malformed",
        "unread_transactions",
        1,
        0,
    ),
    "with_attributes": (data(transaction("1").replace("<Transaction>", '<Transaction at="x">')), "valid", None, 1, 0),
    "nested": (data(f"<Group>{transaction()}</Group>"), "malformed", "unread_transactions", 0, 0),
    "self_closed_in_first_root": (data("<Transaction/>") + data(transaction("1")), "malformed", "unread_transactions", 0, 1),
    "lower_case_roots": (
        data(transaction("1").replace("Transaction>", "transaction>")) + data(transaction("2").replace("Transaction>", "transaction>")),
        "malformed",
        "unread_transactions",
        1,
        0,
    ),
    "lower_case_nested": (
        data(f"<g>{transaction().replace('Transaction>', 'transaction>')}</g>"), "malformed", "unread_transactions", 0, 0
    ),
    "commented_out": (data(transaction(), f"<!-- {transaction('9')} -->"), "valid", None, 1, 0),
    "cdata": (data(transaction(place="<![CDATA[</Transaction>]]>")), "valid", None, 1, 0),
    "entities": (data(transaction(place="A &amp; B")), "valid", None, 1, 0),
}
