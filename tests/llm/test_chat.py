"""The template language by hand, streaming, and odd conversations."""

import hashlib

import pytest

from panelkit.llm import chat

TURNS = [{"role": "system", "content": "Be kind."}, {"role": "user", "content": " Hi? "}, {"role": "assistant", "content": "Hello."}, {"role": "user", "content": "Bye"}]
NAMES = {"bos_token": "<s>", "eos_token": "</s>"}


def run(template, turns=TURNS, names=None, strict=True, lines=False):
    return "".join(x for x, _ in chat.compiled(template, names, strict, lines)(iter(turns)))


# Shapes of templates published with models; their texts are fixed values.
CHATML = """{% if not add_generation_prompt is defined %}{% set add_generation_prompt = false %}{% endif %}{% for message in messages %}{{'<|im_start|>' + message['role'] + '\\n' + message['content'] + '<|im_end|>' + '\\n'}}{% endfor %}{% if add_generation_prompt %}{{ '<|im_start|>assistant\\n' }}{% endif %}"""
SYSTEM_IN_FIRST = """{% if messages[0]['role'] == 'system' %}{% set loop_messages = messages[1:] %}{% set system_message = messages[0]['content'] %}{% else %}{% set loop_messages = messages %}{% set system_message = false %}{% endif %}{% for message in loop_messages %}{% if (message['role'] == 'user') != (loop.index0 % 2 == 0) %}{{ raise_exception('Conversation roles must alternate user/assistant/user/assistant/...') }}{% endif %}{% if loop.index0 == 0 and system_message != false %}{% set content = '<<SYS>>\\n' + system_message + '\\n<</SYS>>\\n\\n' + message['content'] %}{% else %}{% set content = message['content'] %}{% endif %}{% if message['role'] == 'user' %}{{ bos_token + '[INST] ' + content.strip() + ' [/INST]' }}{% elif message['role'] == 'assistant' %}{{ ' ' + content.strip() + ' ' + eos_token }}{% endif %}{% endfor %}"""
LINES = """{% for message in messages %}
{% if message['role'] == 'user' %}
{{ '<|user|>\\n' + message['content'] + eos_token }}
{% elif message['role'] == 'system' %}
{{ '<|system|>\\n' + message['content'] + eos_token }}
{% elif message['role'] == 'assistant' %}
{{ '<|assistant|>\\n'  + message['content'] + eos_token }}
{% endif %}
{% if loop.last and add_generation_prompt %}
{{ '<|assistant|>' }}
{% endif %}
{% endfor %}
"""
HEADERS = """{% set loop_messages = messages %}{% for message in loop_messages %}{% set content = '<|start_header_id|>' + message['role'] + '<|end_header_id|>\\n\\n'+ message['content'] | trim + '<|eot_id|>' %}{% if loop.index0 == 0 %}{% set content = bos_token + content %}{% endif %}{{ content }}{% endfor %}{% if add_generation_prompt %}{{ '<|start_header_id|>assistant<|end_header_id|>\\n\\n' }}{% endif %}"""
SPACED = """{# a namespace, comments and white space control #}
{%- set ns = namespace(found=false, n=0) -%}
{%- for message in messages -%}
    {%- if message.role == 'system' -%}
        {%- set ns.found = true -%}
    {%- endif -%}
    {%- set ns.n = ns.n + 1 -%}
    {{- message.role | upper }}: {{ message.content.strip() -}}
    {%- if not loop.last %},{{ ' ' }}{% endif -%}
{%- endfor -%}
{{- ' (' ~ ns.n ~ ('' if ns.found else ' without') ~ ' system)' -}}
"""


def test_published_shapes():
    assert run(CHATML, names={"add_generation_prompt": True}) == (
        "<|im_start|>system\nBe kind.<|im_end|>\n<|im_start|>user\n Hi? <|im_end|>\n<|im_start|>assistant\nHello.<|im_end|>\n"
        "<|im_start|>user\nBye<|im_end|>\n<|im_start|>assistant\n"
    )
    assert run(CHATML, TURNS[3:]) == "<|im_start|>user\nBye<|im_end|>\n"
    assert run(SYSTEM_IN_FIRST, names=NAMES) == "<s>[INST] <<SYS>>\nBe kind.\n<</SYS>>\n\n Hi? [/INST] Hello. </s><s>[INST] Bye [/INST]"
    assert run(SYSTEM_IN_FIRST, TURNS[1:3], NAMES) == "<s>[INST] Hi? [/INST] Hello. </s>"
    with pytest.raises(chat.TemplateError, match="must alternate"):
        run(SYSTEM_IN_FIRST, TURNS[2:], NAMES)
    assert run(LINES, TURNS[1:], {**NAMES, "add_generation_prompt": True}, lines=True) == (
        "<|user|>\n Hi? </s>\n<|assistant|>\nHello.</s>\n<|user|>\nBye</s>\n<|assistant|>\n"
    )
    assert run(HEADERS, TURNS[1:3], {**NAMES, "add_generation_prompt": True}) == (
        "<s><|start_header_id|>user<|end_header_id|>\n\nHi?<|eot_id|><|start_header_id|>assistant<|end_header_id|>\n\nHello.<|eot_id|>"
        "<|start_header_id|>assistant<|end_header_id|>\n\n"
    )
    assert run(SPACED) == "SYSTEM: Be kind., USER: Hi?, ASSISTANT: Hello., USER: Bye (4 system)"
    assert run(SPACED, TURNS[3:]) == "USER: Bye (1 without system)"


@pytest.mark.parametrize("template, want", [
    ("{{ messages[0]['role'] }}", "system"), ("{{ messages[0].content[0] }}{{ messages[1].content[-2:] }}", "B? "),
    ("{% for m in messages %}{{ m.role[0] }}{% if not loop.last %},{% endif %}{% endfor %}", "s,u,a,u"),
    ("{% for m in messages[2:] %}{{ loop.index }}{{ m.role }}{{ loop.first }}{% endfor %}", "1assistantTrue2userFalse"),
    ("{% for m in messages[1:] %}{{ messages[loop.index0].role[0] }}{{ messages[loop.index0 + 1].role[0] }} {% endfor %}", "su ua au "),
    ("{% for m in messages %}{{ loop.nextitem.role if not loop.last else 'end' }};{% endfor %}", "user;assistant;user;end;"),
    ("{% for m in messages %}{{ loop.previtem.role | default('-') }};{% endfor %}", "-;system;user;assistant;"),
    ("a {# {{ nothing }} #}b", "a b"), ("a  {{- 'b' -}}  c", "abc"), ("{{ '}}' ~ \"{%\" }}", "}}{%"),
    ("{{ x is defined }}{{ messages[0].x is defined }}{{ messages is defined }}", "FalseFalseTrue"),
    ("{{ x | default('y') }}{{ messages[9].role is not defined }}", "yTrue"),
    ("{{ 2 + 3 * 4 - 1 }}|{{ -7 // 2 }}|{{ 7 % 4 }}|{{ (1 + 1) ~ 'a' | upper }}", "13|-4|3|2A"),
    ("{{ 'a' in ['a', 'b'] }}{{ 'c' not in 'abd' }}{{ not 'a' == 'a' }}{{ 1 < 2 and 'b' >= 'a' }}", "TrueTrueFalseTrue"),
    ("{{ 'a-b-c'.split('-')[1:] | length }}{{ 'x'.replace('x', 'yy') }}{{ 'é\"' | tojson }}", '2yy"é\\""'),
    ("{% set k = 1 %}{% for m in messages %}{% set k = k + 1 %}{{ k }}{% endfor %}{{ k }}", "22221"),
    ("{% for x in ['a', 'b'] %}{{ x }}{{ loop.last }}{% endfor %}", "aFalsebTrue"),
    ("{% if messages[3:] %}y{% endif %}{% if messages[4:] %}n{% endif %}{{ none }}{{ true }}", "yNoneTrue"),
    ("{% if false %}{{ 'a' + 1 }}{% elif 1 %}b{% else %}c{% endif %}", "b"),
])
def test_expressions(template, want):
    assert run(template) == want


@pytest.mark.parametrize("bad", [
    "{{ nothing }}", "{{ messages.role }}", "{{ messages[0].nothing }}", "{{ messages[9].role }}", "{{ 'a' + 1 }}", "{{ 1 // 0 }}", "{{ messages }}",
    "{{ messages | length }}", "{{ messages[-1] }}", "{{ messages[:2] }}", "{{ messages[add_generation_prompt] }}", "{% for m in 'abc' %}{% endfor %}",
    "{% for m in messages %}{{ loop.length }}{% endfor %}", "{% for m in messages %}{% endfor %}{% for m in messages %}{% endfor %}",
    "{% for m in messages %}{% set k = 1 %}{% endfor %}{{ k }}", "{% set x = 1 %}{% set x.y = 2 %}", "{{ 'a' < 1 }}", "{{ 'a'.replace('b') }}",
    "{{ raise_exception('no') }}", "{% for m in messages %}{{ messages[loop.index + 1].role }}{% endfor %}", "{{ ['a'] }}",
])
def test_errors_while_rendering(bad):
    render = chat.compiled(bad, strict=True)
    with pytest.raises(chat.TemplateError):
        list(render(iter(TURNS)))


@pytest.mark.parametrize("bad", [
    "{{ 'a' ", "{# a", "{% if 1", "{% if 1 %}", "{% for m in messages %}", "{% else %}", "{% endfor %}", "{% if 1 %}{% else x %}{% endif %}", "{{ 1 < 2 < 3 }}",
    "{{ 'a' 'b' }}", "{{ 1.5 }}", "{{ {'a': 1} }}", "{{ m.__class__ }}", "{{ m.format(1) }}", "{{ range(3) }}", "{{ 'a' | trim(1) }}", "{{ 'a' is odd }}",
    "{% for m in messages if m %}{% endfor %}", "{% macro a() %}{% endmacro %}", "{{ '\\x41' }}", "{{ [1 2] }}", "{{ raise_exception() }}",
])
def test_errors_of_syntax(bad):
    with pytest.raises(chat.TemplateError):
        chat.compiled(bad)


def test_turns_are_streamed():
    ahead = 0

    def turns():
        nonlocal ahead
        for k in range(1000):
            ahead = k
            yield {"role": "user", "content": str(k)}

    pieces = chat.compiled("{{ messages[1].content }}{% for m in messages %}<{{ m.content }}>{% if loop.last %}!{% endif %}{% endfor %}", strict=True)(turns())
    at = -1
    for text, _ in pieces:
        at += text == "<"
        assert ahead <= max(at + 1, 2)
    assert at == ahead == 999


def summary(turns, loss):
    said = "".join(f"{r}\n{t}\n" for r, t in turns)
    return len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_odd_conversations(spark):
    kind = "conv_id long, turn long, role string, text string, piece long, `a.b` string"
    long = "wort \\<|over|> " * 100_000
    rows = [
        (1, 1, "assistant", "yes<|over|>\n", 0, ""), (1, 0, "user", "so?", 0, ""), (1, 0, "user", "so?", 0, ""), (None, 0, "user", None, 0, ""),
        (None, None, None, "late", 0, ""), (2, 0, "assistant", None, 0, ""), (3, 0, "assistant", long, 0, ""), (3, 0, "a|b<|says|>", "", 0, ""),
    ]
    got = {r[0]: tuple(r)[1:5] for r in chat.read_back(chat.formatted(spark.createDataFrame(rows, kind))).collect()}
    assert got == {
        1: summary([("user", "so?"), ("user", "so?"), ("assistant", "yes<|over|>\n")], "yes<|over|>\n"),
        None: summary([("user", ""), ("", "late")], ""), 2: summary([("assistant", "")], ""),
        3: summary([("assistant", long), ("a|b<|says|>", "")], long),
    }
    assert chat.read_back(chat.formatted(spark.createDataFrame([], kind))).count() == 0
    first = chat.formatted(spark.createDataFrame(rows[:3], kind), "{% for m in messages %}{{ m.content }}{% if not loop.last %},{% endif %}{% endfor %}{{ bos }}", names={"bos": "."})
    assert "".join(r.text for r in first.orderBy("piece").collect()) == "so?,so?,yes<|over|>\n."
    with pytest.raises(chat.TemplateError):
        chat.formatted(first, "{{ 'a'")
    with pytest.raises(Exception, match="nobody set 'nothing'"):
        chat.formatted(spark.createDataFrame(rows, kind), "{{ nothing }}").count()
