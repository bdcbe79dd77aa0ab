"""Writes a small ERP export tree (manifests, entity definitions, CSV files)
covering the row cases of FIXTURES.md: NULL keys, padded text, NULL and
DST-edge timestamps, US/USA/NULL countries, 0/1/2 addresses, fiscal periods
with gaps/overlaps/inversions, January promotion windows and volume bands."""

from __future__ import annotations

import csv
import json
import os

N = ""  # empty CSV cell -> NULL


def _write_entity(base, folder, entity, attrs, rows, header=True):
    os.makedirs(f"{base}/{folder}/{entity}", exist_ok=True)
    definition = {"definitions": [{"entityName": entity, "hasAttributes": [
        ({"name": n, "dataFormat": f} if f else {"name": n}) for n, f in attrs]}]}
    with open(f"{base}/{folder}/{entity}.cdm.json", "w") as fh:
        json.dump(definition, fh, indent=1)
    with open(f"{base}/{folder}/{entity}/part-0.csv", "w", newline="") as fh:
        w = csv.writer(fh)
        if header:
            w.writerow([n for n, _ in attrs])
        for r in rows:
            w.writerow(r)


def _manifest(base, folder, entities):
    os.makedirs(f"{base}/{folder}", exist_ok=True)
    with open(f"{base}/{folder}/{folder}.manifest.cdm.json", "w") as fh:
        json.dump({"manifestName": folder, "entities": [{"entityName": e} for e in entities]}, fh)


STD = [("LastProcessedChange_DateTime", "DateTime"), ("DataLakeModified_DateTime", "DateTime")]
RID = [("RecordId", "Int64")]


def write_tree(base: str, extra_sales_lines: list[list] | None = None) -> None:
    _manifest(base, "Others", ["CostCenter", "Currency", "FiscalPeriod"])
    _manifest(base, "Sales", ["CustTable", "PaymentTypes", "PromoTable", "SalesOrderLine"])
    _manifest(base, "Purchase", ["Parties", "PartyAddress", "PurchCategory", "PurchContracts",
                                 "PurchItem", "PurchaseOrder", "VendTable"])
    _manifest(base, "Hr", ["WorkerTable"])

    _write_entity(base, "Others", "CostCenter",
                  [("CostCenterNumber", "String"), *STD, ("Vat", "Decimal"), *RID], [
                      ["CC1", "2024-01-15T12:00:00Z", "2024-01-15T12:00:00Z", "0.2", "1"],
                      [" CC2 ", N, "2024-07-15T12:00:00Z", "0.1", "2"],
                      ["CC3", N, N, "0.05", N],  # NULL record id: dropped
                  ])
    _write_entity(base, "Others", "Currency",
                  [("CurrencyId", "Int32"), ("Code", "String"), *STD, ("Country", "String"),
                   ("CurrencyName", "String"), *RID], [
                      ["1", " USD ", N, "2024-03-10T08:00:00Z", " US ", "Dollar", "11"],
                      ["2", "EUR", "2024-02-01T00:00:00Z", "2024-11-03T07:00:00Z", "DE", " Euro ", "12"],
                      [N, "GBP", N, N, "UK", "Pound", "13"],  # NULL CurrencyId: dropped
                  ])
    _write_entity(base, "Others", "FiscalPeriod",
                  [("RecordId", "Int64"), ("FiscalPeriodName", "String"), ("FiscalStartDate", "Date"),
                   ("FiscalEndDate", "Date"), ("FiscalMonth", "Int32"), ("FiscalYearStart", "Date"),
                   ("FiscalYearEnd", "Date"), ("FiscalQuarter", "Int32"), ("FiscalQuarterStart", "Date"),
                   ("FiscalQuarterEnd", "Date"), ("FiscalYear", "String")], [
                      ["1", "P1", "2024-01-01", "2024-01-31", "7", "2023-07-01", "2024-06-30", "3",
                       "2024-01-01", "2024-03-31", "2024"],
                      ["2", "P2", "2024-02-01", "2024-02-29", "8", "2023-07-01", "2024-06-30", "3",
                       "2024-01-01", "2024-03-31", "2024"],
                      ["3", "P4", "2024-04-01", "2024-04-30", "10", "2023-07-01", "2024-06-30", "4",
                       "2024-04-01", "2024-06-30", "2024"],          # gap: March uncovered
                      ["4", "P4b", "2024-04-20", "2024-05-10", "10", "2023-07-01", "2024-06-30", "4",
                       "2024-04-01", "2024-06-30", "2024"],          # overlaps P4
                      ["5", "PX", "2024-06-30", "2024-06-01", "12", N, N, N, N, N, "2024"],  # inverted
                      ["6", "PN", N, "2024-08-01", "1", N, N, N, N, N, "2025"],              # NULL bound
                      [N, "PNULL", "2024-01-01", "2024-12-31", "1", N, N, N, N, N, "2099"],  # NULL id
                  ])

    _write_entity(base, "Sales", "CustTable",
                  [("CustomerId", "String"), *STD, ("CustomerName", "String"), ("Email", "String"),
                   ("Phone", "String"), ("Address", "String"), ("City", "String"), ("State", "String"),
                   ("Country", "String"), ("Region", "String"), ("SignupDate", "DateTime"), *RID], [
                      ["C1", N, "2024-01-01T00:00:00Z", " Ann ", "a@x ", " 1", " Rd ", "Austin", "TX", "US",
                       "South", "2024-02-01T02:00:00Z", "100"],
                      ["C2", N, N, "Bob", N, N, N, N, N, N, N, N, N],
                  ])
    _write_entity(base, "Sales", "PaymentTypes", [("PaymentTypeId", "Int32"), ("Name", "String")],
                  [["1", "Card"]])
    _write_entity(base, "Sales", "PromoTable",
                  [("PromotionId", "Int32"), *STD, ("PromotionName", "String"), ("PromoCode", "String"),
                   ("PromoType", "String"), ("PromoPercentage", "Double"), ("ValidFrom", "DateTime"),
                   ("ValidTo", "DateTime"), ("IsActive", "Boolean"), *RID], [
                      ["1", N, N, "Volume Discount 11 to 20", "V1", "Vol", "0.1", "2024-01-01T00:00:00Z",
                       "2024-01-10T00:00:00Z", "true", "201"],
                      ["2", N, N, "Volume Discount 21 to 40", "V2", "Vol", "0.2", "2024-01-05T00:00:00Z",
                       "2024-01-31T00:00:00Z", "true", "202"],
                      ["3", N, N, "Volume Discount 41 to 60", "V3", "Vol", "0.3", N, N, "true", "203"],
                      ["4", N, N, "Volume Discount > 60", "V4", "Vol", "0.4", N, N, "true", "204"],
                      ["5", N, N, "Winter Sale", "W", "Season", "0.5", "2024-01-08T00:00:00Z",
                       "2024-01-12T00:00:00Z", "false", "205"],
                  ])
    sol_attrs = [("SalesOrderNumber", "String"), ("SalesOrderLine", "Int32"), *STD, ("ItemId", "String"),
                 ("Qty", "Int32"), ("Price", "Double"), ("VatPercentage", "Double"),
                 ("CurrencyCode", "String"), ("BookDate", "DateTime"), ("ShippedDate", "DateTime"),
                 ("DeliveredDate", "DateTime"), ("TrackingNumber", "String"), ("CustId", "String"),
                 ("PaymentTypeDesc", "String"), *RID]

    def line(no, ln, book, qty, pay, cur="USD", rid=None):
        return [no, str(ln), N, "2024-05-01T00:00:00Z", "I1", qty, "10.0", "0.2", cur, book,
                "2024-05-02T00:00:00Z", N, "T", "C1", pay, rid if rid is not None else str(1000 + ln)]

    lines = [
        line("S1", 1, "2024-01-09T00:00:00Z", "5", "Card"),     # January: windows 1, 2, 5
        line("S1", 2, "2024-01-10T10:00:00Z", "5", "Cash"),     # end day 10:00: not window 1
        line("S1", 3, "2024-03-01T00:00:00Z", "15", "Card"),    # band 11-20
        line("S1", 4, "2024-03-01T00:00:00Z", "61", "Card", cur="EUR"),  # band > 60; EUR unpadded
        line("S1", 5, N, "41", "Wire"),                          # NULL date: band 41-60
        line("S1", 6, "2024-03-01T00:00:00Z", "10", N),          # no band, NULL payment type
        line("S1", 7, "2024-03-01T00:00:00Z", N, "Card"),       # NULL qty
    ]
    _write_entity(base, "Sales", "SalesOrderLine", sol_attrs, lines + (extra_sales_lines or []))

    _write_entity(base, "Purchase", "Parties",
                  [("PartyId", "String"), ("PartyName", "String"), *STD, ("PartyAddressCode", "String"),
                   ("EstablishedDate", "DateTime"), ("PartyEmailId", "String"),
                   ("PartyContactNumber", "String"), ("TaxId", "String"), *RID], [
                      ["P0", " None ", N, N, "A", N, N, N, N, "1"],
                      ["P1", "One", N, N, "A", N, N, N, N, "2"],
                      ["P2", "Two", N, N, "A", N, N, N, N, "3"],
                      ["P9", "NoId", N, N, "A", N, N, N, N, N],
                  ])
    _write_entity(base, "Purchase", "PartyAddress",
                  [("PartyNumber", "String"), *STD, ("Address", "String"), ("City", "String"),
                   ("State", "String"), ("Country", "String"), ("ZipCode", "String"), ("Region", "String"),
                   ("ValidFrom", "DateTime"), ("ValidTo", "DateTime"), *RID], [
                      ["P1", N, N, " A1 ", "C", "S", "US", "1", "R", "2024-01-01T00:00:00Z", N, "11"],
                      ["P2", N, N, "A2", "C", "S", "US", "1", "R", "2024-01-01T00:00:00Z",
                       "2025-01-01T00:00:00Z", "12"],
                      ["P2", N, N, "A3", "C", "S", "US", "1", "R", "2024-01-01T00:00:00Z", N, "13"],
                  ])
    _write_entity(base, "Purchase", "PurchCategory",
                  [("CategoryId", "Int32"), ("CategoryName", "String"), *STD, ("CategoryGroupId", "Int32"),
                   *RID], [["1", " Tools ", N, N, "1", "31"]])
    _write_entity(base, "Purchase", "PurchContracts", [("ContractId", "String")], [["K1"]])
    _write_entity(base, "Purchase", "PurchItem",
                  [("ItemId", "String"), ("Txt", "String"), *STD, ("ValidFrom", "DateTime"),
                   ("ValidTo", "DateTime"), ("Price", "Double"), ("CategoryID", "Int32"), *RID],
                  [["I1", " Hammer ", N, N, N, N, "9.5", "1", "41"]])
    _write_entity(base, "Purchase", "PurchaseOrder",
                  [("PoNumber", "String"), ("LineItem", "Int32"), ("VendId", "String"), *STD,
                   ("Qty", "Int32"), ("PurchasePrice", "Double"), ("TotalOrder", "Double"),
                   ("CostCenter", "String"), ("CurrencyCode", "String"), ("ExchangeRate", "Double"),
                   ("Itemkey", "String"), ("OrderDate", "DateTime"), ("ShipDate", "DateTime"),
                   ("DeliveredDate", "DateTime"), ("TrackingNumber", "String"), ("Batchid", "String"),
                   ("CreatedBy", "String"), ("CategoryId", "Int32"), *RID], [
                      ["PO1", "1", "V1", N, N, "2", "5.0", "100.0", "CC1", "USD", "1.0", "I1",
                       "2024-02-01T02:00:00Z", N, N, N, "B", "me", "1", "51"],
                      ["PO1", "2", "V1", N, N, "2", "5.0", "100.0", "CC2", "EUR", "1.0", "I1",
                       "2024-07-01T02:00:00Z", N, N, N, "B", "me", "1", "52"],
                      ["PO1", "3", "V1", N, N, "2", "5.0", "100.0", "CCX", "XXX", "1.0", "I1",
                       N, N, N, N, "B", "me", "1", "53"],   # unmatched cost centre and currency
                      ["PO1", "4", "V1", N, N, "2", "5.0", "100.0", "CC1", "USD", "1.0", "I1",
                       N, N, N, N, "B", "me", "1", N],      # NULL record id: dropped
                  ])
    _write_entity(base, "Purchase", "VendTable",
                  [("VendId", "String"), ("VendorName", "String"), *STD, ("Address", "String"),
                   ("City", "String"), ("State", "String"), ("Country", "String"), ("ZipCode", "String"),
                   ("Region", "String"), ("ValidFrom", "DateTime"), ("ValidTo", "DateTime"),
                   ("Active", "Boolean"), ("TaxId", "String"), ("CurrencyCode", "String"), *RID], [
                      ["V1", " Acme ", N, N, N, N, N, "US", N, N, N, N, "true", N, " USD ", "61"],
                      ["V2", "Beta", N, N, N, N, N, " US ", N, N, N, N, "true", N, "USD", "62"],
                      ["V3", "Gamma", N, N, N, N, N, "USA", N, N, N, N, "true", N, "USD", "63"],
                      ["V4", "Delta", N, N, N, N, N, N, N, N, N, N, "true", N, "USD", "64"],
                      [N, "NoId", N, N, N, N, N, "US", N, N, N, N, "true", N, "USD", "65"],
                  ])
    _write_entity(base, "Hr", "WorkerTable",
                  [("WorkerID", "String"), *STD, ("SupervisorId", "String"), ("WorkerName", "String"),
                   ("WorkerEmail", "String"), ("Phone", "String"), ("DOJ", "DateTime"), ("DOL", "DateTime"),
                   ("Vertical", "String"), ("Type", "String"), ("PayPerAnnum", "Double"),
                   ("Rate", "Double"), *RID], [
                      ["W1", N, N, N, " Ann ", N, N, N, N, " Sales ", "FTE", "1.0", "1.0", "71"],
                      ["W2", N, N, "W1", "Bob", N, N, N, N, "Sales", "FTE", "1.0", "1.0", "72"],
                      ["W3", N, N, "W1", "Cy", N, N, N, N, "Data & AI", "FTE", "1.0", "1.0", "73"],
                      ["W4", N, N, "W1", "Di", N, N, N, N, N, "FTE", "1.0", "1.0", "74"],
                  ])
