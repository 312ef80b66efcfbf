"""The sentences shown on the report pages, with ``{name}`` places for computed parts."""

OVERVIEW = {
    "data_available": "Dados disponíveis de {first} a {last}",
    "series": "O Brasil se destaca como um importador líquido de pescado, atingindo a máxima histórica de {value} de dólares em {month}",
    "categories": "A categoria {name1} ({id1}) domina {share1} do mercado de exportações, seguida de {name2} ({id2}), com {share2}.",
    "states_title_one": "Quem é o Top 1 estado que mais exporta?",
    "states_title_many": "Quem são os Top {n} estados que mais exportam?",
    "states_span": "Ranking dos estados que mais exportaram, em dólares, no período de {first} - {last}",
    "countries_title_one": "Quem é o principal parceiro comercial do Brasil nas exportações?",
    "countries_title_many": "Quem são os Top {n} parceiros comerciais do Brasil nas exportações?",
    "countries": "{country} lidera as exportações brasileiras de pescado, absorvendo {share} do total, equivalente a U$ {value} durante o período de {first} - {last}",
}
BALANCE = {
    "lowest": "A Balança Comercial de pescado atingiu a mínima histórica em {month}, chegando a {value} de dólares.",
    "real": "Ao comparar o valor nominal da balança comercial com o valor corrigido pela CPI (Consumer Price Index), verificamos que a maior distorção entre o valor nominal e o real foi de {value} de dólares em {month}.",
    "deficit": "Para o peíodo de {first} - {last}, o Brasil possui um déficit acumulado de {value} de dólares.",
    "surplus": "Para o peíodo de {first} - {last}, o Brasil possui um superávit acumulado de {value} de dólares.",
    "heatmap": "{worst} registra o pior saldo médio mensal ({low}) e {best} o melhor ({high}) ao longo dos 20 anos",
}
PRODUCTS = {
    "most_exported_span": "Lideram as exportações acumuladas no período de {first} - {last}",
    "most_imported_title": "...e {name}",
    "dearest_title": "...mas {name}",
    "dearest": "É a categoria de maior valor agregado, valendo {times} mais por quilo.",
    "export_lead": "{name} lideram as exportações há {years} anos consecutivos e acumularam {value} entre {first} - {last}.",
    "import_lead": "{name} lideram as importações há {years} anos consecutivos e acumularam {value} entre {first} - {last}.",
    "yearly_price": "Média geral de {mean} e pico de {peak} no ano de {year}.",
    "category_price": "{name} é a categoria exportada com maior valor agregado ({price}).",
}
PARTNERS = {
    "exports_all": "Destino de {share} de tudo que o Brasil exporta em pescado",
    "exports_one": "Destino de {share} de tudo que o Brasil exporta em {category}",
    "exports_some": "Destino de {share} de tudo que o Brasil exporta para as categorias selecionadas",
    "imports_all": "Destino de {share} de tudo que o Brasil importa em pescado",
    "imports_one": "Destino de {share} de tudo que o Brasil importa em {category}",
    "imports_some": "Destino de {share} de tudo que o Brasil importa para as categorias selecionadas",
    "tornado_title": "Importações e Exportações dos {n} maiores parceiros comerciais do Brasil",
    "tornado": "Top {n} parceiros — {exporter} lidera as exportações ({export_share}) e {importer} as importações ({import_share})",
    "hhi_down": "HHI: índice de concentração de mercado (quanto maior, mais dependente de poucos parceiros) indica que o mercado se diversificou {change} desde {year}",
    "hhi_up": "HHI: índice de concentração de mercado (quanto maior, mais dependente de poucos parceiros) indica que a concentração aumentou {change} desde {year}",
    "hhi_title": "Análise de Concentração de Mercado (HHI) para {flow} - Evolução Anual",
}
STATES = {
    "export_card": "Foi o estado que mais exportou pescado no período de {first} - {last}, acumulando o valor de {value} de dólares e um volume total de {weight}.",
    "import_card": "por outro lado, foi o estado que mais importou pescado para o mesmo período, acumulando o valor de {value} de dólares e um volume total de {weight}.",
    "cities_title": "Exibindo os {n} estados que mais exportaram pescado no período de {first} - {last}",
    "exporting_city": "{city} se destaca como o maior exportador de pescado (U$ {value}) para o período selecionado.",
    "importing_city": "{city} se destaca como o maior importador de pescado (U$ {value}) para o período selecionado.",
    "exporting_cities": "{state} lidera o ranking nacional com {cities} municípios participantes no mercado externo de exportações.",
    "importing_cities": "{state} lidera o ranking nacional com {cities} municípios participantes no mercado de importacoes.",
    "map": "{state} (U$ {value}) apresenta o maior volume financeiro acumulado no período selecionado.",
}
EXPORTS, IMPORTS = "Exportações", "Importações"
