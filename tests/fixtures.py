"""Small XML inputs (FIXTURES.md section 3) written to a temp folder."""

import os

VMP_XML = """<ROOT><VMPS>
<VMP><VPID> 111 </VPID><NM>Co-amoxiclav 250mg</NM><VTMID/></VMP>
<VMP><VPID>222</VPID><NM>  Amoxicillin  </NM><VTMID>9</VTMID><VPIDPREV>221</VPIDPREV></VMP>
<VMP><VPID>333</VPID><NM>Piperacillin / Tazobactam 4g</NM></VMP>
<VMP><VPID>444</VPID><NM>Paracetamol</NM><NM>Second name</NM></VMP>
<VMP><NM>No key</NM></VMP>
</VMPS><OTHER><VMP2><VPID>5</VPID></VMP2></OTHER></ROOT>
"""

BNF_XML = """<ROOT>
<VMP><VPID>222</VPID><BNF_CODE>050101</BNF_CODE><ATC>J01CA04</ATC><DDD>1.5</DDD><DDD_UOMCD>258682000</DDD_UOMCD></VMP>
<VMP><VPID>333</VPID><BNF_CODE>050101</BNF_CODE><ATC/><DDD/><DDD_UOM>g</DDD_UOM></VMP>
<VMP><VPID>444</VPID><BNF_CODE>040701</BNF_CODE><ATC>N02BE01</ATC><DDD>3</DDD><DDD_UOMCD>258684004</DDD_UOMCD></VMP>
<REC><VPID>444</VPID><ATC>N02BE01</ATC><DDD>n/a</DDD></REC>
<VMP><VPID/><ATC>X</ATC></VMP>
<VMP><VPID>999</VPID><ATC>A01AA01</ATC></VMP>
</ROOT>
"""

NAMESPACED_VMP = ('<ROOT xmlns="http://example.org/d" xmlns:p="urn:p"><VMP><VPID>1</VPID><NM>a</NM></VMP>'
                  '<p:VMP><p:VPID>2</p:VPID><p:NM>b</p:NM></p:VMP></ROOT>\n')
BLANK_KEY_BNF = "<ROOT><VMP><VPID> </VPID><ATC>Y</ATC></VMP><VMP><VPID/><ATC>Z</ATC></VMP></ROOT>\n"
NESTED_BNF = "<ROOT><VMP><VPID>1</VPID><REC><VPID>2</VPID><ATC>B</ATC></REC><ATC>A</ATC></VMP></ROOT>\n"
TRUNCATED = "<ROOT><VMP><VPID>1</VPID><NM>broken</NM></VMP><VMP><VPID>2"
NO_RECORD = "<ROOT><OTHER>nothing</OTHER></ROOT>\n"


def write(root, rel, text):
    path = os.path.join(str(root), rel)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def release(root):
    """item_24 and item_25 folders of the main fixture."""
    write(root, "item_24/a/b/f_vmp2_1.xml", VMP_XML)
    write(root, "item_24/a/ignored_f_vmp.txt", "not xml")
    write(root, "item_25/f_bnf1_1.xml", BNF_XML)
    return os.path.join(str(root), "item_24"), os.path.join(str(root), "item_25")
