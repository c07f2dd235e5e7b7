"""Rules that are checked before any data moves."""

import pytest

from ferryline import Connection, LoadOptions, UnloadOptions
from ferryline.functions.names import qualified_name, quote_identifier, spark_name
from ferryline.functions.tokens import deescape_token
from ferryline.options import check_direct


@pytest.mark.parametrize(
    "token,expected",
    [
        ("\\\\N", "\\N"), ("\\n", "\n"), ("\\b", "\b"), ("\\t", "\t"), ("\\f", "\f"),
        ("\\'", "'"), ('\\"', '"'), ("plain", "plain"), ("\\\\n", "\\n"), ("\\r", "\\r"),
        ("\\\\\\\\", "\\\\"), ("\\\\44", "\\44"), ("", ""),
    ],
)
def test_token_deescape(token, expected):
    assert deescape_token(token) == expected


@pytest.mark.parametrize("token", ["\\44", "a\\44", "\\\\\\0"])
def test_octal_tokens_are_refused(token):
    with pytest.raises(ValueError, match="octal"):
        LoadOptions(null_string=token)


def test_null_tokens():
    assert LoadOptions().null_token == "null"
    assert LoadOptions(null_string="\\\\N").null_token == "\\N"
    assert UnloadOptions(null_string="somewhere").null_token == "somewhere"
    for token in ("a,b", "x\\\\", "a\\n"):
        with pytest.raises(ValueError, match="read back"):
            UnloadOptions(null_string=token)


def test_max_errors():
    assert LoadOptions().max_errors == 1
    assert LoadOptions(max_errors="1337").max_errors == 1337
    for wrong in ("notANumber", 0, -1):
        with pytest.raises(ValueError):
            LoadOptions(max_errors=wrong)


@pytest.mark.parametrize("cls", [LoadOptions, UnloadOptions])
def test_ignored_settings_warn(cls):
    with pytest.warns(UserWarning, match="enclosed"):
        assert cls(enclosed_by='"').enclosed_by is None
    with pytest.warns(UserWarning, match="record_delim"):
        assert cls(record_delim="\n").record_delim is None
    for escape in ("X", None):
        with pytest.warns(UserWarning, match="backslash"):
            assert cls(escape=escape).escape == "\\"


def test_separators():
    for delim in ("", ",,", "\\", "\n", "\r"):
        with pytest.raises(ValueError, match="field_delim"):
            LoadOptions(field_delim=delim)
    with pytest.raises(ValueError, match="record_sep"):
        LoadOptions(record_sep="\r\n")
    with pytest.raises(ValueError, match="other than LF"):
        UnloadOptions(newline_policy="escape")
    with pytest.raises(ValueError, match="newline_policy"):
        UnloadOptions(newline_policy="drop")
    with pytest.raises(ValueError, match="bool_style"):
        UnloadOptions(bool_style="YES_NO")
    with pytest.raises(TypeError):
        LoadOptions(colour="red")


@pytest.mark.parametrize("layout", ["hbase", "avro", "sequencefile", "parquet"])
def test_direct_mode_is_text_only(layout):
    with pytest.raises(ValueError, match=f"unsupported argument.*{layout}"):
        check_direct(LoadOptions(), layout=layout)


def test_direct_mode_refusals():
    with pytest.raises(ValueError, match="free-form query"):
        check_direct(UnloadOptions(), query="select 1")
    with pytest.raises(ValueError, match="update mode"):
        check_direct(LoadOptions(), mode="update")
    with pytest.raises(ValueError, match="non-string"):
        check_direct(LoadOptions(null_string="a", null_non_string="b"))


def test_names():
    assert quote_identifier(None) is None
    assert quote_identifier('a"b') == '"a""b"'
    assert qualified_name("t", "s") == '"s"."t"'
    assert qualified_name("t", "") == qualified_name("t") == '"t"'
    assert spark_name("s.t") == "`s`.`t`"


def test_credentials():
    assert Connection("jdbc:x:y", user="", password="p").properties() == {"url": "jdbc:x:y"}
    full = Connection("jdbc:x:y", driver="d", user="u", password="secret")
    assert full.properties() == {
        "url": "jdbc:x:y", "driver": "d", "user": "u", "password": "secret"
    }
    assert "secret" not in repr(full)
