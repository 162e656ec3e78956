"""A book of small pages."""

#: A book of small pages, written for these tests.
BOOK_PAGES = [
    (0, None, "విషయసూచిక\n1. బాల కాండ - మొదటి కథ\n3\n2. బాల కాండ - రెండవ - కథ\n\n5\n"), (1, "1", "ముందుమాట"), (2, None, ""), (3, None, "x"), (4, None, "y"), (5, None, "z"), (6, "2", "w"),
    (7, "3", "1, 2 సర్గలు\n1. ప్రశ్న: మొదటిది ఏది?\nజవాబు: 1. ఒకటి 2. రెండు 3. మూడు 4. నాలుగు\n2. ప్రశ్న: రెండవది?\n1) అవును 2) కాదు"),
    (8, "4", "3. ప్రశ్న : ఎవరు?\n4వ ప్రశ్న\nఎందుకు?\nజవాబు\n: పెద్ద కథ.\n5. పశ్న: ఎలా?\nజవాబు: ఇలా."),
    (9, "5", "జవాబులు:\n1. 2. రెండు 2. 1. అవును 3. వాల్మీకి\n3 సర్గలు\nప్రశ్న: పేరు?\nజవాబు: 1. అ 2. ఆ\n2. ప్రశ్న: ఊరు?\nజవాబు: కథ"), (10, "6", "end")]
