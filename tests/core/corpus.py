"""A small corpus: an act, its order and another act."""

ACT, ORDER, OTHER = "998AC0000000001", "998CO0000000002", "998AC0000000003"


def sentence(text):
    return f"<ParagraphSentence><Sentence>{text}</Sentence></ParagraphSentence>"


def paragraph(num, text, *items):
    made = "".join(f'<Item Num="{n}"><ItemTitle>{t}</ItemTitle><ItemSentence><Sentence>{s}</Sentence></ItemSentence></Item>' for n, t, s in items)
    return f'<Paragraph Num="{num}">{sentence(text)}{made}</Paragraph>'


def article(num, *paragraphs):
    return f'<Article Num="{num}"><ArticleTitle>第{num}条</ArticleTitle>{"".join(paragraphs)}</Article>'


def law(number, title, main, rest="", abbrev=""):
    return f'<Law><LawNum>{number}</LawNum><LawBody><LawTitle Abbrev="{abbrev}">{title}</LawTitle><MainProvision>{main}</MainProvision>{rest}</LawBody></Law>'


ACT_XML = law(
    "令和元年法律第五号",
    "河川<Ruby>舟<Rt>しゅう</Rt></Ruby>運法",
    '<Chapter Num="1"><ChapterTitle>第一章　総則</ChapterTitle>'
    + article("1", paragraph(1, "この法律は、舟運を定める。"))
    + article("2", paragraph(1, "第一条及び第三条の規定は、附則第二条の場合に準用する。", ("1", "一", "舟"), ("1_2", "一の二", "筏"), ("2", "二", "前号に準ずるもの及び前各号のもの")))
    + '</Chapter><Chapter Num="1_2"><ChapterTitle>第一章の二　雑則</ChapterTitle>'
    + article("3", paragraph(1, "料金は政令で定める。"), paragraph(2, "前項の規定は、別表第一及び様式第二に適用する。"))
    + article("3_2", paragraph(1, "前条第二項の規定は、次条に準用する。"))
    + article("4", paragraph(1, "同項とは本項をいう。"))
    + "</Chapter>",
    "<SupplProvision>"
    + article("1", paragraph(1, "この法律は、公布の日から施行する。"))
    + article("2", paragraph(1, "経過措置。"))
    + '</SupplProvision><SupplProvision AmendLawNum="令和四年法律第九号"><Paragraph Num="1">'
    + sentence("第四条を削る改正は、附則第一項による。")
    + "</Paragraph></SupplProvision>"
    + "<AppdxTable><AppdxTableTitle>別表第一（第三条関係）</AppdxTableTitle><Sentence>表</Sentence></AppdxTable><AppdxStyle><AppdxStyleTitle>様式第２</AppdxStyleTitle><Sentence>様</Sentence></AppdxStyle>",
    "舟運法",
)
ORDER_XML = law(
    "令和元年政令第六号",
    "河川舟運法施行令",
    article("1", paragraph(1, "河川舟運法（令和元年法律第五号。以下「法」という。）第二条第一項の者は、法第三条第二項及び第一条に規定する者とする。"))
    + article("2", paragraph(1, "河川舟運法第三条の規定は、同条第二項の者及び同法第一条の者に適用する。"), paragraph(2, "第一条の規定は、前項の場合に準用する。この場合において、同条中「者」は「人」とする。"))
    + article("3", paragraph(1, "河川舟運法第一章（総則）（第一条（目的）を除く。）の規定は、第二条の処分には適用しない。"))
    + article("4", paragraph(1, "旧河川舟運法第二条、旧法第三条及び港湾何某法第五条の例による。"))
    + article("5", paragraph(1, "港湾法（以下「港法」という。）第一条、港法第九条、舟運法第一条第七項、新港湾法第一条及び一部を改正する法律第二条をいう。")),
)
OTHER_XML = law("昭和四十年法律第三十三号", "港湾法", '<Paragraph Num="1">' + sentence("港湾の法。") + "</Paragraph>" + article("1", paragraph(1, "港湾とは、河川舟運法施行令第二条の港をいう。")))


def documents():
    rows = [(ACT, "20190401_000000000000000", "20190401", "a", ACT_XML), (ACT, "20980101_509AC0000000002", "20980101", "b", ACT_XML), (ORDER, "20190401_000000000000000", "20190401", "c", ORDER_XML)]
    return rows + [(OTHER, "20970101_000000000000000", "20970101", "d", OTHER_XML), ("998AC0000000009", "20190401_0", "20190401", "e", "<Law><broken")]
