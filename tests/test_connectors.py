import imaplib
import os

from lettrine.plans import export, mime, parse, pdf
from lettrine.sources import imap, mailbox
from tests.test_pipeline import MIXED, PLAIN, raw


class FakeBox:
    mails = {"Sent": [raw(PLAIN, 1)], "INBOX": [raw(MIXED, 2), b"", raw(PLAIN, 3)]}

    def __init__(self):
        self.closed = False

    def select(self, folder, readonly):
        assert readonly
        self.now = self.mails.get(folder.strip('"'))
        if self.now is None:
            raise imaplib.IMAP4.error("no folder")
        return "OK", [str(len(self.now)).encode()]

    def fetch(self, n, what):
        body = self.now[int(n) - 1]
        return ("OK", [(b"1", body), b")"]) if body else ("OK", [None])

    def logout(self):
        self.closed = True


def test_imap_reader():
    boxes = []

    def opener(options):
        boxes.append(FakeBox())
        return boxes[-1]

    r = imap._Reader({"login": "me", "foldersin": "INBOX,None", "foldersout": "Sent", "perfolder": "5"}, opener)
    rows = [x for p in r.partitions() for x in r.read(p)]
    assert [(x[1], x[2], x[7]) for x in rows] == [("out", "Sent", 1), ("in", "INBOX", 6), ("in", "INBOX", 8)] and all(b.closed for b in boxes)
    assert len([x for p in imap._Reader({"login": "me", "foldersin": "INBOX", "perfolder": "1"}, opener).partitions() for x in imap._Reader({"perfolder": "1"}, opener).read(p)]) == 1


def _bundles(spark, tmp_path, body):
    mailbox.register(spark)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.eml").write_bytes(raw(body))
    listing = spark.read.format("mailbox").option("path", str(tmp_path)).load()
    return parse.bundles(mailbox.contents(parse.pending(listing, spark.createDataFrame([], "folder string, stem string"))))[0]


def test_pdf_text(spark, tmp_path):
    body = MIXED.replace('filename="contract.txt"\r\n\r\nOther', 'filename="x.PDF"\r\n\r\nOther')
    rows = _bundles(spark, tmp_path, body)
    got = {r["attachments"][0]["original_name"]: r["attachments"][0] for r in pdf.with_text(rows, lambda b: 1 / 0, lambda b: " page\r\none ").collect()}
    assert (got["x.PDF"]["extracted_text"], got["x.PDF"]["extracted_text_method"], got["x.PDF"]["extracted_text_truncated"]) == ("page\none", "pdf_ocr", None)
    assert got["contract.txt"]["extracted_text"] is None
    assert all(r["attachments"][0]["extracted_text"] is None for r in pdf.with_text(rows).collect())


def test_pages_in_the_order_of_their_names():
    render = lambda data, n: {f"page-{k:02d}.png": b"%d" % k for k in range(25, 0, -1)}

    def recognise(image):
        if image == b"3":
            raise ValueError("unreadable")
        return None if image == b"4" else f" page {int(image)}\r\n"

    assert pdf.by_pages(render, recognise)(b"x") == "\n\n".join(f"page {k}" for k in range(1, 21) if k not in (3, 4))
    assert pdf.by_pages(lambda data, n: {}, recognise)(b"x") is None


def test_export(spark, tmp_path):
    rows = _bundles(spark, tmp_path, MIXED)
    assert export.write(rows, str(tmp_path / "out")).where("error is not null").count() == 0
    names = sorted(os.listdir(tmp_path / "out" / "in" / "a"))
    assert names == ["contract.json", "contract.txt", "contract.xml", "contract_1.json", "contract_1.txt", "contract_1.xml"]
    assert (tmp_path / "out/in/a/contract.txt").read_bytes().startswith(b"Contract content")


def test_odd_messages():
    assert mime.parse_message("p", b"")["attachments"][0]["meta"]["original_name"] == "email-body.xml"
    odd = b"Subject: =?x?Q?y?=\r\nContent-Type: multipart/mixed; boundary=\"b\"\r\n\r\n--b\r\nContent-Type: application/pdf; name=\"attestation.pdf\"\r\n\r\nx\r\n--b\r\nContent-Type: application/x; name=\"a?.bin\"\r\nContent-Transfer-Encoding: base64\r\n\r\n!!!!\r\n--b--\r\n"
    assert [a["meta"]["original_name"] for a in mime.parse_message("p", odd)["attachments"]] == ["a.bin"]
