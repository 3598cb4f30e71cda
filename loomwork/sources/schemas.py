"""Declared schemas of the inputs the batch and stream jobs know."""

# Column names and types of the known inputs.
CUSTOMERS = "id INT, custfname STRING, custlname STRING, custage SMALLINT, custprofession STRING"
TRANSACTIONS = (
    "txnid INT, dt STRING, custid INT, amt DOUBLE, category STRING, product STRING, "
    "city STRING, state STRING, spendby STRING"
)
CLICKS = (
    "id INT, custid INT, ip STRING, updts TIMESTAMP, year INT, visit_secs INT, http_verb STRING, "
    "short_url STRING, long_url STRING, status_cd INT, upddt DATE"
)
MARKS = "studid INT, studname STRING, m1 INT, m2 INT, m3 INT"
BOOKS = "title STRING, author STRING, year_written INT, edition STRING, price STRING"
