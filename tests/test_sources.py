import os

import pytest

from mailshape.sources.csv_mail import load_training_mails
from mailshape.sources.raw_mail import load_raw_mails, mail_fields
from mailshape.sources.sinks import write_chart_tables, write_report


def write(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data if isinstance(data, bytes) else data.encode())
    return str(path)


def test_text_label_csv(spark, tmp_path):
    path = write(tmp_path / "in put" / "a.csv",
                 'Unnamed: 0,Subject,Message,Spam/Ham\n'
                 '0,Hi,"line one\nline ""two"", end",ham\n'
                 '1,NA,null,SPAM\n'
                 '2,,"",other\n'
                 '3,N/A x,None,Ham\n')
    rows = load_training_mails(spark, path).orderBy("mail_id").collect()
    assert [tuple(r)[1:] for r in rows] == [
        ("Hi", "", 'line one\nline "two", end', 0), ("", "", "", 1), ("", "", "", None),
        ("N/A x", "", "", 0)]
    assert rows[0].asDict().keys() == {"mail_id", "subject", "sender", "body", "label"}


def test_number_label_csv_over_files_in_name_order(spark, tmp_path):
    head = ",label,subject,email_from,message\n"
    write(tmp_path / "d" / "b.csv", head + "0,1,s3,f3,m3\n")
    write(tmp_path / "d" / "a.csv", head + "0,0,s1,f1,m1\n1,1.0,s2,,m2\n" + "2,1,x,y,z\n" * 50)
    rows = load_training_mails(spark, str(tmp_path / "d")).orderBy("mail_id").collect()
    assert [tuple(r)[1:] for r in rows[:2]] == [("s1", "f1", "m1", 0), ("s2", "", "m2", 1)]
    assert tuple(rows[-1])[1:] == ("s3", "f3", "m3", 1)
    assert len({r.mail_id for r in rows}) == 53


def test_files_of_other_column_order_are_refused(spark, tmp_path):
    write(tmp_path / "d" / "a.csv", "label,subject,email_from,message\n0,s1,f1,m1\n")
    write(tmp_path / "d" / "b.csv", "subject,label,message,email_from\ns2,1,m2,f2\n")
    with pytest.raises(Exception, match="header"):
        load_training_mails(spark, str(tmp_path / "d")).collect()
    write(tmp_path / "e" / "a.csv", "label,subject,email_from,message\n0,s1,f1,m1\n")
    write(tmp_path / "e" / "b.csv", "Subject,Message,Spam/Ham\ns2,m2,spam\n")
    with pytest.raises(Exception):
        load_training_mails(spark, str(tmp_path / "e")).collect()


def test_first_layout_wins_and_unknown_is_rejected(spark, tmp_path):
    both = write(tmp_path / "both.csv",
                 "Subject,Message,Spam/Ham,label,subject_,email_from,message_\nS,M,spam,0,x,y,z\n")
    assert load_training_mails(spark, both).first().label == 1
    bad = write(tmp_path / "bad.csv", "subject,body\na,b\n")
    with pytest.raises(ValueError, match="bad.csv"):
        load_training_mails(spark, bad)


RAW = {
    "plain": (b"Subject: S\nFrom: a@b\n\nbody\n", ("S", "a@b", "body\n")),
    "html_only": (b"Subject: S\nContent-Type: text/html\n\n<b>x</b>", ("S", "", "<b>x</b>")),
    "both": (b'Content-Type: multipart/alternative; boundary="B"\n\n--B\nContent-Type: text/plain\n\n'
             b'one\n--B\nContent-Type: text/html\n\n<i>two</i>\n--B\n\nthree\n--B--\n',
             ("", "", "one three")),
    "empty_plain": (b'Content-Type: multipart/alternative; boundary="B"\n\n--B\nContent-Type: text/plain'
                    b'\n\n\n--B\nContent-Type: text/html\n\n<i>two</i>\n--B--\n', ("", "", "")),
    "base64": (b"Content-Type: text/plain\nContent-Transfer-Encoding: base64\n\naGVsbG8=\n", ("", "", "hello")),
    "quoted": (b"Content-Transfer-Encoding: quoted-printable\n\ncaf=C3=A9=\n!", ("", "", "café!")),
    "latin1": (b"Content-Type: text/plain; charset=iso-8859-1\n\ncaf\xe9", ("", "", "caf�")),
    "raw_8bit_subject": (b"Subject: caf\xe9\nFrom: a@b\n\nx", ("", "a@b", "x")),
    "encoded_word": (b"Subject: =?utf-8?q?caf=C3=A9?=\n\nx", ("=?utf-8?q?caf=C3=A9?=", "", "x")),
    "folded": (b"Subject: one\n two\n\nx", ("one\n two", "", "x")),
    "no_headers": (b"\njust text", ("", "", "just text")),
    "crlf": (b"Subject: S\r\n\r\na\r\nb", ("S", "", "a\nb")),
    "bogus_type": (b"Content-Type: nonsense\n\nx", ("", "", "x")),
    "nested": (b'Content-Type: multipart/mixed; boundary="A"\n\n--A\nContent-Type: multipart/alternative; '
               b'boundary="B"\n\n--B\nContent-Type: text/html\n\n<p>h</p>\n--B\n\np\n--B--\n--A\n'
               b'Content-Type: text/plain\nContent-Disposition: attachment\n\nattached\n--A--\n',
               ("", "", "p attached")),
    "image": (b"Content-Type: image/png\n\nabc", ("", "", "")),
}


@pytest.mark.parametrize("name", RAW)
def test_raw_mail_fields(name):
    content, want = RAW[name]
    assert mail_fields(content) == want


def test_raw_folders(spark, tmp_path):
    names = sorted(RAW)
    for name in names:
        write(tmp_path / "test" / "easy_ham" / name, RAW[name][0])
    write(tmp_path / "test" / "easy_ham" / ".hidden", b"Subject: no\n\nx")
    write(tmp_path / "test" / "easy_ham" / "sub" / "deeper", b"Subject: no\n\nx")
    with pytest.warns(UserWarning, match="spam_2"):
        rows = load_raw_mails(spark, str(tmp_path)).orderBy("mail_id").collect()
    assert [r.mail_id for r in rows] == list(range(len(names)))
    assert [(r.subject, r.sender, r.body) for r in rows] == [RAW[n][1] for n in names]
    assert {r.label for r in rows} == {0}

    write(tmp_path / "spam_2" / "0", b"Subject: spam\n\nbuy")
    write(tmp_path / "easy_ham" / "9", b"Subject: ham\n\nhi")
    rows = load_raw_mails(spark, str(tmp_path)).orderBy("mail_id").collect()
    assert [(r.mail_id, r.subject, r.label) for r in rows] == [(0, "ham", 0), (1, "spam", 1)]


def test_sinks(spark, tmp_path):
    frame = spark.createDataFrame([(1, 2.0)], "a int, b double")
    write_report(frame, str(tmp_path / "report"), "json")
    assert spark.read.json(str(tmp_path / "report")).count() == 1
    for model in ("one", "two", "two"):
        write_chart_tables({"curve": frame}, str(tmp_path / "charts"), model)
    back = spark.read.parquet(str(tmp_path / "charts" / "curve"))
    assert sorted(r.model for r in back.collect()) == ["one", "two"]
