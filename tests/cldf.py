"""Small datasets in files, each made to hit certain traps."""

import json
from pathlib import Path


def descriptor(forms=0, languages=0, parameters=0, versions=None, **more):
    kinds = [("FormTable", forms), ("LanguageTable", languages), ("ParameterTable", parameters)]
    return {
        "dc:title": "A title", "dc:bibliographicCitation": "Someone 2020", "dcat:accessURL": "https://example.org", "dc:license": "CC-BY", "dc:conformsTo": "http://cldf.clld.org/v1.0/terms.rdf#Wordlist",
        "tables": [{"dc:conformsTo": f"http://cldf.clld.org/v1.0/terms.rdf#{k}", "dc:extent": n} for k, n in kinds],
        "prov:wasDerivedFrom": [{"dc:title": k, "dc:created": v} for k, v in (versions or {"Repository": "v1", "Glottolog": "v4.7", "Concepticon": "v3.0", "CLTS": "v2.2"}).items()],
        "prov:wasGeneratedBy": [{"dc:title": "python", "dc:description": "3.11"}],
    } | more


def dataset(root, name, described=None, **tables):
    """Files by keyword, ``forms="..."`` for forms.csv; ``sources`` is the bibliography."""
    folder = Path(root, name, "cldf")
    folder.mkdir(parents=True)
    (folder / "cldf-metadata.json").write_text(json.dumps(described or descriptor()))
    for table, text in tables.items():
        (folder / ("sources.bib" if table == "sources" else f"{table}.csv")).write_bytes(text.encode())


LANGUAGES = "ID,Name,Glottocode,Glottolog_Name,Latitude,Longitude\nL1,One,aaaa1111,Alang,1.5,2\nL2,Two,bbbb1111,Blang,,\n"
PARAMETERS = "ID,Name,Concepticon_ID,Concepticon_Gloss\nP1,hand,1277,HAND\nP2,eye,1248,EYE\nP3,sun,,\n"


def write_all(root):
    dataset(
        root, "alpha", descriptor(6, 2, 3),
        forms="ID,Local_ID,Language_ID,Parameter_ID,Value,Form,Segments,Source,Loan,Cognacy\n1,x1,L1,P1,va,fa,f a,K1; K2;;,true,42\n2,x2,L1,P2,vb,fb,f b, ; ,false,\n3,x3,L1,P3,vc,fc,,K1,,a;b\n4,x4,L2,P1,vd,fd,f d,,True,\n5,x5,L2,P2,NA,fe,,,,\n6,,L2,P3,vf,ff,,,,\n",
        languages=LANGUAGES, parameters=PARAMETERS,
        cognates="ID,Form_ID,Cognateset_ID,Alignment,Doubt,Source\n1,1,hand-1,,true,K1\n2,1,hand-66,n u m a,false,\n3,2,eye-1,e y e,,K2\n4,3,,s u n,false,\n5,4,hand-1,h a,true,\n",
        sources="@article{K1,\n title={One}}\n\n@book{K2,\n title={Two}, note={a@b.c}}\n\n@comment{x, y}\n",
    )
    dataset(
        root, "beta", descriptor(4, 2, 3),
        forms='Form,Loan,ID,Extra,Parameter_ID,Language_ID,Value\r\n"a, ""q""",true,1,x,P1,L1,NA\r\nb,false,2,x,P2,L1,"two\nlines"\r\nc,True,3,x,P3,L2,v\r\nd,,4,x,P1,L2,\r\n',
        languages=LANGUAGES, parameters=PARAMETERS,
    )
    dataset(
        root, "gamma",
        forms="ID,Language_ID,Parameter_ID,Value,Alignment,Glottocode\n1,L1,P1,v,own a,\n2,L1,P2,v,,own0001\n",
        languages=LANGUAGES, parameters=PARAMETERS, cognates="Form_ID,Cognateset_ID,Alignment\n1,c1,file a\n2,c2,file b\n",
    )
    dataset(
        root, "delta",
        forms="ID,Language_ID,Parameter_ID,Value\n1,L1,P1,v\n2,L1,P2,v\n", languages=LANGUAGES, parameters=PARAMETERS,
        cognates="Form_ID,Cognateset_ID,Alignment,Morpheme_Index,Segment_Slice\n1,c1,n u m a,1,1:2\n1,c2,n u - -,2,3\n2,c3,e,,\n2,c3,e,,\n",
    )
    dataset(
        root, "epsilon",
        forms="ID,Language_ID,Parameter_ID,Value,Source\n1,L9,P1,v,K1\n1,L9,P9,v,K9\n2,,P1,v,\n", languages=LANGUAGES, parameters=PARAMETERS, sources="@misc{K1,\n}\n",
    )
    dataset(root, "zeta", forms="ID,Language_ID,Parameter_ID,Value\n", languages=LANGUAGES, parameters=PARAMETERS, cognates="Form_ID,Cognateset_ID\n")
    dataset(root, "eta", forms="ID,Language_ID,Parameter_ID\n1,L1,P1\n", languages=LANGUAGES)
    described = descriptor(9, 9, 9, versions={"Other": "v0"})
    described["tables"].insert(0, {"dc:conformsTo": None, "dc:extent": 7})
    described["prov:wasGeneratedBy"] = []
    dataset(
        root, "theta", described, forms="ID,Language_ID,Parameter_ID\n1,L1,P1\n", parameters=PARAMETERS,
        languages="ID,Name,Latitude,Longitude\nL1,a,28.0,abc\nL2,b,1.0d,nan\nL3,c,,-1e1\n",
    )
    dataset(root, "iota", forms="ID,Language_ID\n1,L1\n", languages=LANGUAGES, parameters=PARAMETERS)
    dataset(root, "kappa", forms="ID,Language_ID,Parameter_ID\n1,L1,P1,too,many\n", languages=LANGUAGES, parameters=PARAMETERS)
    registry = Path(root).parent / "registry.csv"
    registry.write_bytes(b"NAME,URL,CoreCog,CORE\r\n alpha ,https://x/alpha,TRUE,TRUE\r\ngamma,https://x/gamma,,TRUE\r\ndelta,https://x/delta,TRUE,\r\nabsent,https://x/absent,TRUE,TRUE\r\nnourl,,true,TRUE\r\n")
    return str(registry)
