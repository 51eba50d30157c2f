"""Forms of assignments whose literals are secrets, and some whose are not."""

import pytest

from tenureframe.llm import secrets

FORMS = [
    ('password: str = "hunter2secret"', "hunter2secret"),
    ('password: Optional[str] = "hunter2secret"', "hunter2secret"),
    ('api_key: str | None = "hunter2secret"', "hunter2secret"),
    ('const token: string = "hunter2secret";', "hunter2secret"),
    ('private apiKey?: string = "hunter2secret";', "hunter2secret"),
    ('var apiKey string = "hunter2secret"', "hunter2secret"),
    ('let token: &str = "hunter2secret";', "hunter2secret"),
    ("let token: &'static str = \"hunter2secret\";", "hunter2secret"),
    ('let mut password: std::string::String = "hunter2secret";', "hunter2secret"),
    ('String password = "hunter2secret";', "hunter2secret"),
    ('char password[] = "hunter2secret";', "hunter2secret"),
    ('password = b"hunter2secret"', "hunter2secret"),
    ("smtp_pwd=ab12!cd34EFgh", "ab12!cd34EFgh"),
    ("export smtp_pwd=ab12!cd34&EF,gh # of the mail server", "ab12!cd34&EF,gh"),
    ("db_password: !ab12(cd)34EFgh", "!ab12(cd)34EFgh"),
    ("send smtp_pwd=ab12!cd34EFgh, then wait", "ab12!cd34EFgh"),
    ("SMTP_PWD=correcthorsebattery\n", "correcthorsebattery"),
    ("smtp_pwd: correct-Horse!battery\r\n", "correct-Horse!battery"),
    ("[mail]\nsmtp_pwd = correcthorsebattery", "correcthorsebattery"),
    ('password = """hunter2secret"""', "hunter2secret"),
    ("password = '''hunter2\"secret'''", 'hunter2"secret'),
    ('salt = "hunter2secret";\nsmtpPwd = salt;\n', "hunter2secret"),
    ('cfg=dict(smtp_pwd="hunter2secret")', "hunter2secret"),
    ("url=http://example.org/?smtp_pwd=hunter2secret", "hunter2secret"),
    ('password: str = """\n  hunter2secret\n"""\n', "hunter2secret"),
    ("token = `Zx9kk22aaQQ12`", "Zx9kk22aaQQ12"),
    ("user, password = 'bob', 'Zx9kk22aaQQ12'", "Zx9kk22aaQQ12"),
    ("const [user, password] = ['Zx8kk33bbRR13', 'Zx9kk22aaQQ12'];", "Zx9kk22aaQQ12"),
    ('password, user := "Zx9kk22aaQQ12", "bob"', "Zx9kk22aaQQ12"),
    ('<add key="password" value="Zx9kk22aaQQ12"/>', "Zx9kk22aaQQ12"),
    ("<property\n  name='db.password'\n  value='Zx9kk22aaQQ12' />", "Zx9kk22aaQQ12"),
    ('<input value="Zx9kk22aaQQ12" id="apiKey">', "Zx9kk22aaQQ12"),
    ("Authorization: Bearer Zx9kk22.aaQQ12-x_y", "Zx9kk22.aaQQ12-x_y"),
    ('headers = {"Authorization": "Bearer Zx9kk22aaQQ12"}', "Zx9kk22aaQQ12"),
    ("curl -H 'authorization: basic Zx9kk22aaQQ12=='", "Zx9kk22aaQQ12=="),
    ("password: |\n  Zx9kk22aaQQ12\nuser: bob\n", "Zx9kk22aaQQ12"),
    ("  db:\n    password: >-\n      Zx9kk22aaQQ12\n    user: bob\n", "Zx9kk22aaQQ12"),
    ('secret = x\nx = "Zx9kk22aaQQ12"\n', "Zx9kk22aaQQ12"),
    ('secret = x\nx = y\ny = "Zx9kk22aaQQ12"\n', "Zx9kk22aaQQ12"),
    ('client.set_password("Zx9kk22aaQQ12")', "Zx9kk22aaQQ12"),
    ("x = 'Zx9kk22aaQQ12'\nclient.setPassword(x)", "Zx9kk22aaQQ12"),
    ('props.setProperty("smtp.password", "Zx9kk22aaQQ12");', "Zx9kk22aaQQ12"),
    ("postgres://bob:Zx9kk22aaQQ12@db.example.org/x", "Zx9kk22aaQQ12"),
    ("redis://:Zx9kk22aaQQ12@cache:6379", "Zx9kk22aaQQ12"),
]


@pytest.mark.parametrize("text, secret", FORMS)
def test_the_whole_literal_is_found(text, secret):
    assert [text[s:e] for s, _, e in secrets.literal_spans(text)] == [secret]
    hidden = secrets.redact(text, secrets.find_spans(text)[1])
    assert not any(secret[i : i + 4] in hidden for i in range(len(secret) - 3))


PARTS = [
    ('key = "pw-" + "Zx9kk22aaQQ12"; api_key = key', ["pw-", "Zx9kk22aaQQ12"]),
    ("$smtp_password = 'Zx9kk2' . '2aaQQ12';", ["Zx9kk2", "2aaQQ12"]),
    ('half = "Zx9kk2"\nsmtp_password = half + "2aaQQ12"', ["Zx9kk2", "2aaQQ12"]),
    ('half = "Zx9kk2"\nsmtp_password = half+"2aaQQ12"', ["Zx9kk2", "2aaQQ12"]),
    ('smtp_password = "Zx9kk2" "2aaQQ12"', ["Zx9kk2", "2aaQQ12"]),
    ("private_key: |\n  Zx9kk22a\n\n  bbQQ12cc\nuser: bob", ["Zx9kk22a", "bbQQ12cc"]),
]


@pytest.mark.parametrize("text, parts", PARTS)
def test_every_part_of_a_literal_is_found(text, parts):
    assert [text[s:e] for s, _, e in secrets.literal_spans(text)] == parts


def test_no_tail_of_a_value_is_left():
    text = "password=abcdefgh12!moreOfIt34\nother=1"
    assert secrets.redact(text, secrets.find_spans(text)[1]) == "[SECRET]\nother=1"


@pytest.mark.parametrize(
    "text",
    [
        "token: string", "password: SecretStr", "credentials: Credentials", "self.password = password",
        "apiKey = settings.defaultvalue", "PASSWORD=$OTHER_VARIABLE", "PASSWORD=${OTHER_VARIABLE}",
        'title: str = "A long story of 1999"', 'password: str = ""', 'password = """',
        "token = found[index]", "password=getpassword()", "token = generatedvalue;",
        "The key: everybody agreed on it.", "if password == expected:",
        "token_count = 12345678901", "max_token_length: 1234567890123", 'secret_name = "prod/Db1-main"',
        'password_file = "/run/Secrets/db1"', 'login(user, password)', "user, password = read_pair()",
        "https://example.org:8080/user@host", "Authorization: Bearer ${TOKEN}", "password: |\nuser: bob1",
        '<add key="title" value="Zx9kk22aaQQ12"/>', 'show.set_title("Zx9kk22aaQQ12")', "secret = x\nx = read()",
    ],
)
def test_names_types_and_prose_are_none(text):
    assert secrets.literal_spans(text) == []


def test_long_lines_take_linear_time():
    for text in ("key: a<" * 20_000, "a " * 40_000 + "=", "a:" * 40_000, 'key="""' * 20_000,
                 "a1" * 200_000 + "=", "set(" * 50_000, "<a " * 50_000 + "=", "://a" * 50_000,
                 "a," * 50_000 + "=", 'key="a"' + '+"b"' * 50_000, "x = " + "a" * 300_000,
                 "".join(f"a{i} = a{i + 1}\n" for i in range(20_000)) + 'a20000 = "Zx9kk22aaQQ12"',
                 "key: |\n" * 20_000, "key: |\n" + "  a\n" * 50_000):
        secrets.find_spans(text)
