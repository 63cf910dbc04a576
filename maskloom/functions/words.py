"""Word lists the dictionary fakes draw from.

Invented for this package. A deployment may pass longer lists of its own to the fakes; larger
spaces come from combining lists (first x last, adjective x noun x form).
"""

FIRST_NAMES = (
    "Ada Alma Anton Arlo Astrid Basil Bela Bruno Cara Cleo Cyril Dana Desmond Dora Edda Elias "
    "Elin Emil Esme Fabian Farah Felix Flora Gideon Greta Hana Hector Ida Ilse Imran Ines Jonas "
    "Judith Kaito Kira Lars Leila Lionel Lotte Magnus Maren Milo Mina Nadia Nils Noor Odette "
    "Omar Oskar Petra Quentin Rafael Ramona Rhea Rosa Silas Sonja Tariq Tilda Ursula Viktor "
    "Wanda Yusuf Zelda"
).split()

LAST_NAMES = (
    "Abara Almquist Amsel Arden Bahri Baxley Belmont Birk Borowski Brandt Calloway Castell "
    "Corvin Dalton Dressel Eklund Elmore Ferrand Fiala Fosse Galvan Garnier Hale Halloran Hartwig "
    "Hollis Ibarra Ivers Jansky Jorgens Kaplan Kestrel Kovar Lanza Larkin Lindqvist Lorimer "
    "Madsen Marlow Mbeki Merrick Moravec Nakata Norwood Okoye Orsini Pascal Pellman Quist Radley "
    "Renner Rosvall Sandoval Selby Storm Tanaka Thorne Ulrich Valdez Verhoeven Wexler Winslow "
    "Yilmaz Zander"
).split()

COMPANY_ADJECTIVES = (
    "Amber Arctic Atlas Blue Bright Cedar Clear Cobalt Copper Coral Crescent Delta Eastern Ember "
    "Evergreen Falcon Golden Granite Harbor Indigo Ivory Juniper Keystone Lunar Maple Meridian "
    "Noble Northern Opal Orion Pacific Pine Pioneer Prime Quartz Red River Sable Silver Solar "
    "Summit Terra Urban Velvet Vista Western Willow Zenith"
).split()

COMPANY_NOUNS = (
    "Analytics Apparel Bakery Builders Ceramics Chemicals Components Consulting Dairy Design "
    "Dynamics Electric Energy Engines Fabrics Farms Foods Freight Furniture Glass Hardware Health "
    "Instruments Interiors Labs Logistics Machinery Media Metals Mills Motors Networks Optics "
    "Packaging Paper Partners Plastics Power Printing Robotics Shipping Software Steel Supply "
    "Systems Textiles Tools Works"
).split()

COMPANY_FORMS = ["Ltd", "LLC", "Inc", "GmbH", "SA", "BV", "Co", "Group"]

STREETS = (
    "Acorn Alder Ash Aspen Bay Beacon Beech Birch Bridge Brook Canal Castle Chapel Cherry Church "
    "Clover Corn Dale Elder Elm Fern Field Forest Garden Gate Glen Grove Harbor Hazel Heath Hill "
    "Holly Iris Ivy Lake Lark Laurel Lilac Linden Market Meadow Mill Moss Oak Orchard Park Pond "
    "Poplar Quarry Ridge River Rose Rowan School Spring Station Stone Sunset Tower Vale Valley "
    "Willow Wood"
).split()

STREET_KINDS = ["Street", "Road", "Avenue", "Lane", "Way", "Close", "Drive", "Square"]

CITIES = (
    "Aldermere Ashbourne Baywick Belhaven Birchford Bramley Brookhollow Calder Carrow Claymont "
    "Cranford Dunmere Eastvale Elmstead Fairholm Farrow Fernhill Foxdale Glenport Greyford Halston "
    "Harwick Hazelton Highmoor Holmbury Ironbridge Kelby Kingsmere Lakeford Langdale Larkfield "
    "Marshwood Millbrook Netherby Newhaven Northam Oakhurst Oldbury Pinewick Portmere Queensford "
    "Ravenhall Redmoor Rivermouth Rosedale Saltwick Sandholm Sherbrook Silverton Southmere "
    "Stonegate Summerby Thornbury Upton Valebrook Wansford Waterby Westholm Whitmoor Wickford "
    "Windrush Woodhall Wyverton Yarrow"
).split()

# The placeholder vocabulary of free-text redaction, in its order of use.
FILLER_WORDS = (
    "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod "
    "tempor incididunt ut labore et magna aliqua"
).split()

FILLER = " ".join(FILLER_WORDS) + " "
