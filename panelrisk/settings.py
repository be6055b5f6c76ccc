"""Default parameters. Every operator takes them as arguments."""

# Labels, cut points, weights, periods and text formats that the
# results must carry literally.

MISSING_LABEL = "Sem dado"

RATE_CUTS = (5.0, 10.0, 20.0)
RATE_LABELS = ("Baixo", "Moderado", "Alto", "Crítico")

SCORE_CUTS = (20.0, 35.0, 50.0)
SCORE_LABELS = ("Baixo", "Moderado", "Alto", "Critico")

PREDICTION_CUTS = (5.0, 10.0, 15.0)
PREDICTION_LABELS = ("Baixo", "Moderado", "Alto", "Crítico")

INDEX_WEIGHTS = {"taxa_evasao_em": 0.40, "tdi_em": 0.30, "taxa_repetencia_em": 0.30}
SCORE_WEIGHTS = {"taxa_abandono_em": 0.40, "tdi_em": 0.30, "taxa_reprovacao_em": 0.30}

PERIODS = (
    (2010, "2006–2010"),
    (2015, "2011–2015"),
    (2019, "2016–2019"),
    (2022, "2020–2022 (Pandemia)"),
)
PERIODS_LAST = "2023–2024"

PERIODS_ALT = ((2010, "2006-2010"), (2015, "2011-2015"), (2020, "2016-2020"))
PERIODS_ALT_LAST = "2021-2024"

SHOCK_WINDOW = (2020, 2022)
BASELINE_WINDOW = (2016, 2019)
SPLIT_YEAR = 2017

# indicator -> (attention, critical), both inclusive
DIAGNOSIS_LIMITS = {
    "taxa_evasao_em": (5.0, 10.0),
    "taxa_abandono_em": (5.0, 10.0),
    "tdi_em": (20.0, 30.0),
    "taxa_repetencia_em": (8.0, 15.0),
    "taxa_evasao_ef": (3.0, 6.0),
}
DIAGNOSIS_LEVELS = ("OK", "Atencao", "Critico")

# indicator -> True when lower is better
LOWER_IS_BETTER = {
    "taxa_evasao_em": True,
    "taxa_abandono_em": True,
    "tdi_em": True,
    "taxa_repetencia_em": True,
    "taxa_aprovacao_em": False,
}

CORR_STRENGTH = ((0.8, "muito forte"), (0.6, "forte"))
CORR_STRENGTH_ELSE = "moderada"
CORR_REPORT_ABOVE = 0.4
CORR_INVERSE_TEXT = "mais aprovacao = menos evasao"
CORR_DIRECT_TEXT = "ambos sobem juntos"

AT_RISK_LIMITS = {"taxa_abandono_em": 10.0, "taxa_abandono_ef": 5.0}
SPARSE_SHARE = 0.5

SCENARIO_TOLERANCE = 1e-6
SCENARIO_EFFECT = 0.01
SCENARIO_TEXT_EFFECT = 0.05
SCENARIO_HIGH_RISK = 12.0

# column -> (label, min, max, step, default, unit)
SCENARIO_INPUTS = {
    "tdi_em": ("TDI — defasagem idade-série (EM, %)", 0.0, 100.0, 0.5, 25.0, "%"),
    "taxa_reprovacao_em": ("Taxa de reprovação (EM, %)", 0.0, 100.0, 0.5, 10.0, "%"),
    "taxa_aprovacao_em": ("Taxa de aprovação (EM, %)", 0.0, 100.0, 0.5, 85.0, "%"),
    "taxa_repetencia_em": ("Taxa de repetência (EM, %)", 0.0, 100.0, 0.5, 8.0, "%"),
    "taxa_abandono_ef": ("Taxa de abandono (EF, %)", 0.0, 100.0, 0.5, 3.0, "%"),
    "atu_em": ("Alunos por turma — ATU (EM)", 10.0, 45.0, 0.5, 35.0, "alunos"),
    "had_em": ("Horas diárias de aula — HAD (EM)", 3.0, 10.0, 0.1, 5.5, "h"),
    "tdi_ef": ("TDI — defasagem idade-série (EF, %)", 0.0, 100.0, 0.5, 20.0, "%"),
    "taxa_reprovacao_ef": ("Taxa de reprovação (EF, %)", 0.0, 100.0, 0.5, 8.0, "%"),
}

SCENARIO_TEXT = {
    "none": "Nenhum indicador foi alterado em relação ao cenário atual da escola selecionada. "
    "A previsão de abandono permanece em **%s%%**.",
    "tiny": "Os indicadores foram ajustados, mas as mudanças foram muito pequenas para alterar "
    "materialmente a previsão (**%s%%** → **%s%%**).",
    "down": "a redução de **%s** de %s para %s",
    "up": "o aumento de **%s** de %s para %s",
    "joined": ", combinada com ",
    "less": " resultou em uma **diminuição estimada de %s p.p.** "
    "na taxa de abandono prevista (de **%s%%** para **%s%%**).",
    "more": " resultou em um **aumento estimado de %s p.p.** "
    "na taxa de abandono prevista (de **%s%%** para **%s%%**).",
    "flat": " teve **impacto marginal** na previsão (%s%% → %s%%).",
    "still_high": " Mesmo após a melhoria simulada, o risco previsto permanece **elevado** — "
    "outros indicadores (como reprovação ou TDI) ainda pesam no modelo.",
    "high": " O risco permanece **elevado** devido aos altos níveis de reprovação, defasagem "
    "ou outros indicadores observados pelo modelo.",
    "gain": " A simulação sugere **ganho de risco** em relação ao cenário atual.",
    "note": " *Resultado baseado nos padrões aprendidos pelo modelo — simulação de apoio "
    "à decisão, não garantia de efeito causal na rede.*",
}

# (urgency, title, indicator text, column or None, decimals)
ACTIONS = (
    ("IMEDIATA", "Monitorar frequencia dos alunos do EM semanalmente",
     "Abandono EM atual: %s%% (limite aceitavel: 5%%)", "taxa_abandono_em", 1),
    ("IMEDIATA", "Reforco escolar para alunos com defasagem (TDI alto)",
     "TDI EM atual: %s%% (limite aceitavel: 20%%)", "tdi_em", 1),
    ("CURTO PRAZO", "Revisar a politica de reprovacao — progressao com suporte",
     "Reprovacao EM atual: %s%% (limite aceitavel: 8%%)", "taxa_repetencia_em", 1),
    ("CURTO PRAZO", "Reduzir o numero de alunos por turma no Ensino Medio",
     "Alunos por turma EM atual: %s (meta: ate 30)", "atu_em", 0),
    ("MEDIO PRAZO", "Ampliar oferta de EJA e Ensino Medio noturno",
     "Evasao acumulada cria uma populacao fora do sistema", None, 0),
    ("LONGO PRAZO", "Implantar apoio inteligente ao monitoramento por escola",
     "Exporte os resultados do modelo e consulte-os no painel", None, 0),
)

CV_DIAGNOSIS = {
    "unstable": "instabilidade temporal relevante",
    "overfit": "overfitting moderado",
    "underfit": "underfitting",
    "stable": "razoavelmente estável",
}

SEARCH_SPACE = {
    "stepSize": (0.03, 0.05, 0.08, 0.1, 0.15),
    "maxDepth": (2, 3, 4, 5),
    "maxIter": (80, 120, 160, 220),
    "minInstancesPerNode": (5, 8, 12, 16, 20, 24),
}

# algorithm -> run -> parameters; Spark's boosting has no L2 term and no leaf-count limit
CAMPAIGN = {
    "boosting": {
        "hgb_01_baseline": {"stepSize": 0.15, "maxDepth": 3, "maxIter": 80, "minInstancesPerNode": 24},
        "hgb_02_mais_iter_l2": {"stepSize": 0.1, "maxDepth": 4, "maxIter": 180, "minInstancesPerNode": 16},
        "hgb_03_arvore_rasa": {"stepSize": 0.1, "maxDepth": 2, "maxIter": 220, "minInstancesPerNode": 20},
        "hgb_04_balanceado": {"stepSize": 0.1, "maxDepth": 4, "maxIter": 220, "minInstancesPerNode": 12},
        "hgb_05_lr_alto_curto": {"stepSize": 0.2, "maxDepth": 3, "maxIter": 60, "minInstancesPerNode": 30},
        "hgb_06_lr_baixo_longo": {"stepSize": 0.05, "maxDepth": 3, "maxIter": 300, "minInstancesPerNode": 18},
        "hgb_07_profundo_moderado": {"stepSize": 0.08, "maxDepth": 5, "maxIter": 200, "minInstancesPerNode": 14},
        "hgb_08_folhas_pequenas": {"stepSize": 0.12, "maxDepth": 3, "maxIter": 150, "minInstancesPerNode": 8},
        "hgb_09_l2_forte": {"stepSize": 0.1, "maxDepth": 3, "maxIter": 250, "minInstancesPerNode": 22},
        "hgb_10_muito_raso": {"stepSize": 0.08, "maxDepth": 2, "maxIter": 280, "minInstancesPerNode": 28},
    },
    "tree": {
        "tree_01_rasa": {"maxDepth": 3, "minInstancesPerNode": 12},
        "tree_02_media": {"maxDepth": 4, "minInstancesPerNode": 8},
        "tree_03_profunda": {"maxDepth": 6, "minInstancesPerNode": 4},
        "tree_04_folhas_grandes": {"maxDepth": 5, "minInstancesPerNode": 16},
        "tree_05_muito_rasa": {"maxDepth": 2, "minInstancesPerNode": 20},
        "tree_06_media_folhas_grandes": {"maxDepth": 4, "minInstancesPerNode": 20},
        "tree_07_profunda_restrita": {"maxDepth": 7, "minInstancesPerNode": 8},
        "tree_08_intermediaria": {"maxDepth": 5, "minInstancesPerNode": 6},
        "tree_09_super_rasa": {"maxDepth": 2, "minInstancesPerNode": 30},
        "tree_10_muito_profunda": {"maxDepth": 8, "minInstancesPerNode": 5},
    },
    "knn": {
        "knn_01_poucos_vizinhos": {"k": 3, "weights": "uniform"},
        "knn_02_padrao": {"k": 5, "weights": "distance"},
        "knn_03_mais_vizinhos": {"k": 7, "weights": "distance"},
        "knn_04_muitos_vizinhos": {"k": 11, "weights": "distance"},
        "knn_05_k4_uniform": {"k": 4, "weights": "uniform"},
        "knn_06_k6_distance": {"k": 6, "weights": "distance"},
        "knn_07_k9_distance": {"k": 9, "weights": "distance"},
        "knn_08_k13_distance": {"k": 13, "weights": "distance"},
        "knn_09_k15_uniform": {"k": 15, "weights": "uniform"},
        "knn_10_k5_uniform": {"k": 5, "weights": "uniform"},
    },
}
